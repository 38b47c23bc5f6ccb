"""Ranked search against scores of every (item, document) pair."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from fiscalflow.llm import fp_tree_search as op

WORD = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    vectors = [(d, Counter(t), len(t)) for d, t in ((d, terms(x)) for d, x in docs) if t]
    n_docs, total = len(vectors), sum(n for _, _, n in vectors)
    df = Counter(t for _, v, _ in vectors for t in v)
    out = []
    for item, text in items:
        scores = []
        for doc, tf, n in vectors:
            m = 100 - 50 + 50 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 20 * m)) for t in set(terms(text)) if t in tf)
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block, leaf, k", [(64, 4, 5), (1000, 1, 3), (7, 2, 50)])
def test_brute_force(spark, block, leaf, k):
    rng = random.Random(block)
    zipf = [f"t{i}" for i in range(60) for _ in range(60 // (i + 1))]
    docs = [(i, " ".join(rng.choices(zipf, k=rng.choice([1, 3, 20, 60])))) for i in range(400)]
    docs += [(1000 + i, "t1 t2 t2 t40") for i in range(80)] + [(i, None) for i in range(3)] + [(5, "t50 É.t50"), (None, "t1 t2 t2 t40"), (7, "...")]
    items = [(i, " ".join(rng.choices(zipf, k=6))) for i in range(12)] + [(50, None), (51, "absent"), (52, "T50, é É"), (3, "t40"), (None, "t2 t40 t55")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = op.rank_items(d, spark.createDataFrame(items, "item_id long, text string"), k=k, block=block, leaf=leaf)
    assert rows(got) == brute(docs, items, k)


def test_groups_of_items(spark):
    docs = [(i, f"a{i % 7} b{i % 5} c") for i in range(100)]
    items = [(i, f"a{i % 8} b{i % 6}") for i in range(30)]
    got = op.rank_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), group_items=7)
    assert rows(got) == brute(docs, items)


def test_branches_are_left_out():
    """The bound holds for each node, and rare terms leave most leaves unscored."""
    rng = np.random.default_rng(1)
    df = np.array([900, 500, 300, 40, 20, 5])
    lists = [np.flatnonzero(rng.random(6) < df / 1000) for _ in range(1000)]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    found = np.concatenate(lists)
    tfs = rng.integers(1, 4, len(found))
    tree = op.Tree(np.arange(1000), rng.integers(60, 200, 1000), offsets, found, tfs, np.arange(6), 16)
    assert sorted(tree.doc.tolist()) == list(range(1000))
    weights = np.array([10, 700, 1200, 3100, 3900, 5200])
    best = op.Best(5)
    dense = np.zeros(6, np.int64)
    scored = op.search(tree, np.zeros(1000, bool), np.arange(6), weights, dense, best)
    leaves = sum(not c for c in tree.children)
    assert leaves > 10 and scored < leaves / 2
    part = tree.parts * weights[tree.terms]
    scores = np.array([part[a:b].sum() for a, b in zip(tree.offsets[:-1], tree.offsets[1:])])
    expect = sorted(zip(-scores, tree.doc))[:5]
    assert list(zip(best.score, best.doc)) == [(-s, d) for s, d in expect]


def test_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "the word", 9), (2, "a", 9), (None, None, 9)], "item_id long, text string, rank int")
    got = op.rank_items(odd_documents, items)
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert rows(got) == brute(docs, [(1, "the word"), (2, "a"), (None, None)])
    assert op.rank_items(no_documents, items).count() == 0
    assert op.rank_items(odd_documents, items.limit(0)).count() == 0
