from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from llm.tables import documents

from fiscalflow.llm import sharding


def check(rows, want):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < 40 and r["law"] == "key"
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def expected(docs):
    return Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)


def test_documents(spark):
    docs = documents(spark, "sf0.01")
    rows = sharding.shard_documents(docs).collect()
    check(rows, expected([(r["doc_id"], r["text"]) for r in docs.collect()]))
    by_key = defaultdict(set)
    for r in rows:
        by_key[r["doc_id"]].add(r["shard"])
    assert all(len(x) == 1 for x in by_key.values())
    moved = sum(r["grown_shard"] == 40 for r in rows)
    assert 5 <= moved <= 60  # 1000 / 41 expected


def test_odd_rows(odd_documents, no_documents):
    check(sharding.shard_documents(odd_documents).collect(), expected([(r["doc_id"], r["text"]) for r in odd_documents.collect()]))
    assert sharding.shard_documents(no_documents).count() == 0


def test_weights_and_confined_moves(spark):
    d = spark.range(40_000).withColumnRenamed("id", "k")
    old = [sharding.Shard(r, 10 * r + c, 100 * r + 10 * c + s, 1.0 + s) for r in range(3) for c in range(2) for s in range(2)]
    heavier = [sharding.Shard(x.region, x.rack, x.shard, 4.0 if x.shard == 211 else x.weight) for x in old]
    d = sharding.place(sharding.place(d, "k", old, "a"), "k", heavier, "b")
    n = Counter()
    for r in d.groupBy("a", "b").count().collect():
        n[(r["a"], r["b"])] = r["count"]
    share = Counter()
    for (a, _), c in n.items():
        share[a] += c / 40_000
    assert all(abs(share[x.shard] - x.weight / 18) < 0.01 for x in old)
    # only subtrees whose weight changed take rows: region 2, in it rack 21, in it shard 211
    assert all(a == b or b // 100 == 2 for a, b in n)
    assert all(a == b or not (a // 100 == b // 100 == 2) or b // 10 == 21 for a, b in n)
    assert all(a == b or not (a // 10 == b // 10 == 21) or b == 211 for a, b in n)
