from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from llm.tables import documents

from fiscalflow.llm import simhash_vp as sv


def brute_print(text, k=4):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), (text or "").encode()))
    if not w:
        return 0
    grams = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, ids, bits=4):
    f = sv.Forest(len(prints))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                f.link(i, j)
    least = {}
    for i, d in enumerate(ids):
        r = f.root(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [least.get(f.root(i)) for i in range(len(prints))]


def check(docs, **options):
    rows = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["fp"] % 2**64, r["component_id"]) for r in
                   sv.near_duplicates(docs.select("doc_id", "text"), **options).collect()), key=str)
    given = docs.select("doc_id", "text").collect()
    prints, ids = [brute_print(r["text"]) for r in given], [r["doc_id"] for r in given]
    want = sorted(((i is None, i or 0, p, c) for i, p, c in zip(ids, prints, brute_components(prints, ids))), key=str)
    assert rows == want


def test_documents(spark):
    check(documents(spark, "sf0.01"))


def test_small_shards_take_every_level(spark):
    check(documents(spark, "sf0.01"), shard_limit=3)


def test_odd_rows(odd_documents, no_documents):
    check(odd_documents)
    assert sv.near_duplicates(no_documents).count() == 0


def test_vp_tree_links_what_brute_force_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 40, np.uint64)
    near = base[rng.integers(0, 40, 1500)]
    for _ in range(6):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64)) * (rng.random(len(near)) < 0.6)
    fp = np.unique(np.concatenate([base, near, rng.integers(0, 2**64, 500, np.uint64)]))
    forest = sv.Forest(len(fp))
    for i in range(len(fp)):
        for j in np.nonzero(np.bitwise_count(fp[:i] ^ fp[i]) <= 4)[0]:
            forest.link(i, int(j))
    assert sv.vp_links(fp, 4, leaf=8).tolist() == [forest.root(i) for i in range(len(fp))]


def test_keep_one_keeps_one_row_of_each_component(spark, odd_documents, scratch):
    odd_documents.write.parquet(f"{scratch}/d")
    d = spark.read.parquet(f"{scratch}/d")
    kept = sv.keep_one(d)
    assert kept.columns == d.columns
    comps = sv.near_duplicates(d.select("doc_id", "text")).select("component_id").distinct().collect()
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted(c["component_id"] for c in comps if c["component_id"] is not None)


def test_shards_that_span_arrow_batches_stay_whole(spark):
    # chains whose ends are only linked by way of all their rows, one shard each
    shards = [(k, (k << 40) | ((1 << 4 * i) - 1)) for k in range(1, 61) for i in range(2 + k % 7)]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "5")
    try:
        d = spark.createDataFrame(shards, "shard long, fp long").coalesce(1)
        edges = sv.shard_edges(d, 4).collect()
    finally:
        spark.conf.set(name, before)
    fps = [fp for _, fp in shards]
    forest = sv.Forest(len(fps))
    for e in edges:
        forest.link(fps.index(e["u"]), fps.index(e["v"]))
    assert len({forest.root(i) for i in range(len(fps))}) == 60


def test_trees_are_built_in_the_shards_of_the_given_tables(spark):
    """Every shard of two or more goes through the tree, and the larger ones are split at vantage points."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    fps = sv.saved(sv.fingerprints(docs).select("fp").distinct())
    sizes = sv.deal(fps, 4, 8192).groupBy("shard").count()
    assert sizes.where("count > 4").count() > 100
    fp = np.array([r.fp for r in fps.collect()], np.int64).view(np.uint64)
    forest = sv.Forest(len(fp))
    for i in range(len(fp)):
        for j in np.nonzero(np.bitwise_count(fp[:i] ^ fp[i]) <= 4)[0]:
            forest.link(i, int(j))
    place = {int(x): i for i, x in enumerate(fp)}
    mine = sv.Forest(len(fp))
    for e in sv.shard_edges(sv.deal(fps, 4, 8192), 4).collect():
        mine.link(place[e.u % 2**64], place[e.v % 2**64])
    assert [mine.root(i) for i in range(len(fp))] == [forest.root(i) for i in range(len(fp))]


@pytest.mark.parametrize("n", [2, 3, 5, 11, 64])
def test_small_shards(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        fp = np.unique(rng.integers(0, 64, n).astype(np.uint64) * np.uint64(0x10001))
        forest = sv.Forest(len(fp))
        for i in range(len(fp)):
            for j in np.nonzero(np.bitwise_count(fp[:i] ^ fp[i]) <= 4)[0]:
                forest.link(i, int(j))
        assert sv.vp_links(fp, 4).tolist() == [forest.root(i) for i in range(len(fp))]
