"""Each stage of the pipeline against brute force on the rows that the stage before left, and run() as a whole."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.test_decontam import brute as contamination
from llm.test_quality import brute_base

import corpus_pipeline
from fiscalflow.llm import simhash_vp as sv

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __n string, row string, shard string, size string, score double"


def prose(rng, n):
    return " ".join(rng.choice(("the", "of", "and", "to", "in", "is", "that", "it")) if rng.random() < 0.45 else
                    "".join(rng.choices("etaoinshrdlu", k=rng.randint(3, 8))) + rng.choice(("", "", "", ".", ",")) for _ in range(n))


def planted():
    """Documents with their kind, and benchmark items."""
    rng = random.Random(12)
    items = [(i, prose(rng, 30)) for i in range(4)] + [(9, None), (10, "")]
    rows = [("clean", prose(rng, rng.randint(60, 200))) for _ in range(60)]
    copies = [prose(rng, 120) for _ in range(5)]
    rows += [("copy", c) for c in copies for _ in range(6)]
    rows += [("near", c.replace("the", "The", 1) + " ") for c in copies]
    rows += [("short", prose(rng, 20)), ("short", ""), ("short", None), ("repeats", "one two three " * 60)]
    rows += [("tainted", prose(rng, 60) + " " + items[i % 4][1] + " " + prose(rng, 60)) for i in range(6)]
    rows += [("touched", prose(rng, 3000) + " " + " ".join(items[0][1].split()[:13]) + " " + prose(rng, 400))]
    rng.shuffle(rows)
    docs = [(None if i == 5 else i, t, "en" if i % 7 else None, rng.choice(["hot", "hot", "b", None]), None, "n", "mine", "x", None, 0.5) for i, (_, t) in enumerate(rows)]
    return docs, [k for k, _ in rows], items


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("corpus"))
    docs, kinds, items = planted()
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, kinds


@pytest.fixture(scope="module")
def stages(spark, tables):
    """{stage: rows}, each stage written and read again; "documents" are the input."""
    d, _ = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, d).write.parquet(f"{d}/stage-{name}")
        docs = spark.read.parquet(f"{d}/stage-{name}")
        out[name] = docs.collect()
    return out


def texts(rows):
    return Counter(r.text for r in rows)


def test_the_contract_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "mixing_sources", "sharding"]


def test_all_but_the_last_return_the_columns_of_documents(stages):
    columns = SCHEMA.replace(",", " ").split()[::2]
    assert all(list(r.asDict()) == columns for name, _ in corpus_pipeline.STAGES[:-1] for r in stages[name])


def test_quality(stages, tables):
    """Whoever breaks a base rule goes; documents of plain prose stay."""
    kept, before = texts(stages["quality_rules"]), texts(stages["documents"])
    for t, n in before.items():
        assert kept[t] == (0 if brute_base(t)[-1] else n), t


def test_near_duplicates(stages):
    """One document of each component of fingerprints within 4 bits: the one of the least id."""
    rows = stages["quality_rules"]
    fp = np.array([sv.fingerprint(r.text, 4) for r in rows], np.uint64)
    forest = sv.Forest(len(rows))
    for i in range(len(rows)):
        for j in np.nonzero(np.bitwise_count(fp[:i] ^ fp[i]) <= 4)[0]:
            forest.link(i, int(j))
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(forest.root(i), []).append((r.doc_id is None, r.doc_id or 0))
    want = sorted(min(g) for g in groups.values())
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in stages["simhash_near_dedup"]) == want
    assert len(want) < len(rows) - 20


def test_decontamination(stages):
    rows = stages["simhash_near_dedup"]
    found = contamination([(i, r.text) for i, r in enumerate(rows)], planted()[2])
    want = Counter(rows[x[0]].text for x in found if not x[-1])
    assert texts(stages["benchmark_decontamination"]) == want and 0 < sum(want.values()) <= len(rows) - 6


def test_mixing_keeps_all_rows(stages):
    assert sorted(map(repr, stages["mixing_sources"])) == sorted(map(repr, stages["benchmark_decontamination"]))


def test_sharding(stages):
    rows, before = stages["sharding"], stages["mixing_sources"]
    assert sorted(map(repr, (r.doc_id for r in rows))) == sorted(map(repr, (r.doc_id for r in before)))
    sums = Counter((len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in before)
    assert Counter((r.size, r.text_crc32) for r in rows) == sums
    slots = {}
    for r in rows:
        assert 0 <= r.shard < 40 and r.grown_shard in (r.shard, 40)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_is_its_stages(spark, tables, stages):
    got = corpus_pipeline.run(spark, tables[0]).select("doc_id", "size", "text_crc32", "shard").collect()
    assert sorted(map(repr, got)) == sorted(repr(r) for r in spark.createDataFrame(stages["sharding"]).select("doc_id", "size", "text_crc32", "shard").collect())


def test_odd_rows_and_empty_tables(spark, tmp_path, odd_documents, no_documents):
    for name, docs in (("odd", odd_documents), ("none", no_documents)):
        d = f"{tmp_path}/{name}"
        docs.write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(1, "x y z"), (None, None)] if name == "odd" else [], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        # each of the odd texts breaks a base rule
        assert all(brute_base(r.text)[-1] for r in docs.collect()) and corpus_pipeline.run(spark, d).collect() == []
