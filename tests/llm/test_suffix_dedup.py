from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm.tables import documents

from fiscalflow.llm import queries
from fiscalflow.llm import suffix_dedup as sd


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, sha256) by counting every string."""
    data = [(t or "").encode() for t in texts]
    times = Counter(hash(d[i:i + length]) for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        spans = sd.merged([(i, i + length) for i in range(len(d) - length + 1) if times[hash(d[i:i + length])] > 1])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + d[at:a], b
        kept += d[at:]
        out.append((len(d), len(d) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, path, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(path)
    got = {r["doc_id"]: tuple(r)[1:5] for r in sd.remove_repeats(spark.read.parquet(path), **options).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, options.get("length", 400))
    return got


@pytest.mark.parametrize("hot", [4096, 1])
def test_documents(spark, hot):
    df = documents(spark, "sf0.01")
    given = df.select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:5] for r in sd.remove_repeats(df, hot=hot).collect()}
    assert [got[r["doc_id"]] for r in given] == brute([r["text"] for r in given], 400)


@pytest.mark.parametrize("alphabet,hot,batch", [("ab", 4096, 20_000), ("ab", 2, 3), ("abcdé", 3, 2)])
def test_short_strings_over_small_alphabets(spark, scratch, alphabet, hot, batch):
    rng = random.Random(alphabet + str(hot))
    base = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(60)]
    texts = base + [x[rng.randint(0, 5):] + rng.choice(base)[:20] + x[:9] for x in base] + [None, "", "a" * 200, "ab" * 70]
    got = check(spark, f"{scratch}/t", texts, length=16, gram=5, hot=hot, batch=batch)
    assert any(r[1] for r in got.values()) and any(not r[1] and r[0] > 16 for r in got.values())


def test_odd_rows(odd_documents, no_documents, scratch, spark):
    odd_documents.write.parquet(f"{scratch}/d")
    d = spark.read.parquet(f"{scratch}/d")
    given = [r["text"] for r in d.collect()]
    got = Counter(tuple(r)[1:5] for r in sd.remove_repeats(d).collect())
    assert got == Counter(brute(given, 400))
    assert sd.remove_repeats(no_documents).count() == 0


def test_input_that_is_no_scan(spark):
    """A frame that numbers its rows anew each time it is computed is saved first."""
    df = documents(spark)
    want = sorted(tuple(r)[:5] for r in sd.remove_repeats(df, stable=True).collect())
    assert sorted(tuple(r)[:5] for r in sd.remove_repeats(df.repartition(7)).collect()) == want


def test_kept_text(spark):
    got = {r.doc_id: r for r in queries.op1_suffix_dedup(spark, "/root/testdata/sf0.001").collect()}
    for r in documents(spark).collect():
        g = got[r.doc_id]
        if not g.n_removed:
            assert g.kept == (r.text or "")
        elif "\ufffd" not in g.kept:
            assert len(g.kept.encode()) == g.n_bytes - g.n_removed and hashlib.sha256(g.kept.encode()).hexdigest() == g.kept_sha256


def test_induction_gives_the_prefixes_of_a_plain_sort():
    rng = random.Random(5)
    text = ["".join(rng.choices("ab", k=30)).encode() for _ in range(80)]
    left, right = [t[:12] for t in text], [t[12:] for t in text]
    got = sd.induce(np.zeros(80, np.int64), left, right, 18)
    for i, t in enumerate(text):
        for a in range(13):
            s = t[12 - a:30 - a]
            want = any(u[12 - a:30 - a] == s for j, u in enumerate(text) if j != i)
            assert got[i, a] == want
