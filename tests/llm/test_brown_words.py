"""Every training word is clustered by its own bigrams, not by its ending."""

from __future__ import annotations

from collections import Counter

import numpy as np
from llm.tables import documents
from pyspark.sql import functions as F

from fiscalflow.llm import brown_lm as lm


def columns(df):
    return df.select("doc_id", F.monotonically_increasing_id().alias("row"), lm.held_out(F.col("doc_id")).alias("held"), "text")


def start_of(d, top, endings, classes, batch):
    return lm.Start(lm.unit_bigrams(d, top, endings, batch), top, endings, classes, 10)


def entries(rows):
    return {(bytes(r["word"]), int(k), int(n)) for r in rows for k, n in np.frombuffer(bytes(r["profile"]), lm.ENTRY)}


def test_profiles_are_counts_of_neighbours(spark):
    d = columns(documents(spark))
    top = lm.top_units([b"the", b"a"])
    start = start_of(d, top, 8, 4, 500)
    size, want = int(start.cls.max()) + 1, Counter()
    cls = lambda w: 0 if w == lm.END else int(start.cls[lm.unit_of(w, top, 8)])
    for r in d.where("not held").collect():
        t = [lm.END, *(r["text"] or "").encode().lower().split(), lm.END]
        for before, w, after in zip(t, t[1:-1], t[2:]):
            want[w, cls(after)] += 1
            want[w, size + cls(before)] += 1
    for batch in (500, 2_000_000):
        got = lm.word_profiles(d, start, batch).collect()
        assert len({bytes(r["word"]) for r in got}) == len(got)
        assert entries(got) == {(w, k, n) for (w, k), n in want.items()}


def test_words_of_one_ending_part_by_their_neighbours(spark, monkeypatch):
    # words of one ending, none of them frequent, stand where p stands (between l and m) or where q stands (between r and s)
    rows = [(i, f"l {'p' if i % 2 else f'x{i}ing'} m" if i % 4 < 2 else f"r {'q' if i % 2 else f'x{i}ing'} s") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    d, top = columns(df), lm.top_units([b"l", b"m", b"p", b"q", b"r", b"s"])
    start = start_of(d, top, 4, 7, 3000)
    assert len({lm.unit_of(f"x{i}ing".encode(), top, 4) for i in range(50)}) == 1
    profiles = lm.word_profiles(d, start, 3000)
    found = {}
    for r in lm.words_by_class(profiles, lm.clustered(lm.alike(profiles), start, 10)).collect():
        w = bytes(r["word"]).decode()
        if w.endswith("ing"):
            found.setdefault(int(w[1:-3]) % 4 < 2, set()).add(r["cls"])
            assert r["c"] == 1
    assert len(found[True]) == len(found[False]) == 1 and found[True] != found[False]
    monkeypatch.setattr(lm, "START", 7)
    worth = lambda **o: lm.score(df, endings=4, classes=7, **o).agg(F.sum("score")).first()[0]
    assert worth() > worth(top=7) + 100


def test_sweeps_raise_the_likelihood(spark):
    d = columns(documents(spark))
    start = start_of(d, {}, 200, 12, 2_000_000)
    alikes = lm.alike(lm.word_profiles(d, start, 2_000_000)).cache()
    assert alikes.agg(F.sum("words")).first()[0] > alikes.count()
    sums, worth = lm.Sums(start.bigrams, start.bigrams.T), []
    for _ in range(4):
        sums, now = lm.swept(alikes, sums)
        worth.append(now)
    assert worth[1] > worth[0] and worth[3] > worth[1] and sums.tokens[0] == 0


def test_held_out_text_is_likelier_than_by_the_bounded_model(spark):
    df = documents(spark, "sf0.01")
    worth = lambda **o: lm.score(df, **o).where("held_out").agg(F.sum("score")).first()[0]
    assert worth() > worth(top=768)


def test_blanks_of_all_kinds_and_no_words(spark):
    texts = ["  Ab\tcD \n", "", None, "\x0b\x0c\r", " x ÉÉ"]
    got = lm.score(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), batch=2).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {0: 3, 1: 1, 2: 1, 3: 1, 4: 3}
