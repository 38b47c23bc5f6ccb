"""Ranked lexical search: a document FP-tree and branch and bound for every item.

1. The terms of the items (the query set) are the vocabulary; every document is reduced to its term
   vector over it: (term, tf) and the number of all its terms.  One pass over the texts; N, L and the
   document frequencies are sums over all documents.
2. Documents are dealt to tasks as they lie.  A task puts blocks of ``block`` documents into FP-trees:
   vectors ordered by document frequency (most frequent term first) and sorted, so that equal beginnings
   share a path; siblings of few documents share a leaf of about ``leaf`` documents.
3. Every node has, for its subtree, the greatest tf of each term and the least m.  As a term's
   part of the score grows with tf and falls with m, their sum over an item's terms of positive
   weight bounds every score below the node.  For every item the tree is searched depth first, the
   children of highest bound first; a branch whose bound is below the item's k-th best score so far is
   left out.  The k best go on from block to block.
4. Each task returns at most k documents an item; Spark ranks those.

Nothing is dropped: a branch is only left out if none of its documents can be among the k best
(equal scores are searched, since the smaller doc_id wins).  Items are worked on in groups that fit
the driver and a closure, ``group_items`` items or ``group_bytes`` bytes of text each.

Defined cases: null is a text without terms; documents without terms count nowhere; a document
with a null doc_id ranks after its equals; repeated rows are documents of their own; items without
terms, or whose terms occur nowhere, have no rows; each row of the items is a query, so a repeated item_id
has its ranks twice; empty tables give an empty result; other columns aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalflow.llm._common import batches, saved
from fiscalflow.llm._words import NOT_WORD, chunks, kinds, same_bytes, split

TABLE = kinds(NOT_WORD)
NO_ID = np.iinfo(np.int64).max
RESTRICTED = "doc long, n long, terms array<int>, tfs array<int>"


def item_terms(items: DataFrame, item_id: str, text: str) -> list[tuple[object, list[bytes]]]:
    """(item_id, distinct terms) of a bounded group of items."""
    out = []
    for row in items.select(F.col(item_id).alias("item"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).toLocalIterator():
        w = split(pa.array([row["text"]]), TABLE)
        out.append((row["item"], sorted({w.data[a:b].tobytes() for a, b in zip(w.start, w.end)})))
    return out


def restricted(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc, n, terms, tfs) of every document with a term; ``docs``: doc, text."""
    joined = pa.array([b" ".join(vocabulary)]).cast(pa.string())

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = split(joined, TABLE)
        h = known.hashes()
        order = np.argsort(h)
        h = h[order]
        for b in chunks(it):
            w = split(b.column("text"), TABLE)
            n = np.bincount(w.doc, minlength=len(b))
            doc, term = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if len(h) and len(w):
                mine = w.hashes()
                at = np.minimum(np.searchsorted(h, mine), len(h) - 1)
                hit = np.flatnonzero(h[at] == mine)
                t = order[at[hit]]
                hit, t = (x[same_bytes(w.data, w.start[hit], w.end[hit], known.data, known.start[t], known.end[t])] for x in (hit, t))
                doc, term = w.doc[hit], t
            pair, tf = np.unique(doc * len(vocabulary) + term, return_counts=True)
            sizes = np.bincount(pair // max(1, len(vocabulary)), minlength=len(b))
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (pair % max(1, len(vocabulary)), tf)]
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(n), *lists], names=["doc", "n", "terms", "tfs"]).filter(pa.array(n > 0))

    return batches(docs, run, RESTRICTED)


class Tree:
    """The FP-tree of a block; documents stand in the order of their paths."""

    def __init__(self, doc: np.ndarray, m: np.ndarray, offsets: np.ndarray, terms: np.ndarray, tfs: np.ndarray, rank: np.ndarray, leaf: int):
        size = np.diff(offsets)
        owner = np.repeat(np.arange(len(doc)), size)
        order = np.lexsort((rank[terms], owner))
        path = rank[terms][order].astype(">u4")
        keys = [path[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        seat = np.array(sorted(range(len(doc)), key=keys.__getitem__), np.int64)
        # the entries in the new order of documents, each by rank
        self.size = size[seat]
        self.offsets = np.concatenate(([0], np.cumsum(self.size)))
        pick = np.repeat(offsets[:-1][seat] - self.offsets[:-1], self.size) + np.arange(self.offsets[-1])
        self.terms, self.tfs, self.path = terms[order][pick], tfs[order][pick].astype(np.int64), path[pick].astype(np.int64)
        self.doc, self.m = doc[seat], m[seat]
        self.parts = gain(self.tfs, np.repeat(self.m, self.size))
        self.grow(leaf)
        self.bound(len(rank))

    def grow(self, leaf: int) -> None:
        lo, hi, parent = [0], [len(self.doc)], [-1]
        self.children: list[list[int]] = [[]]
        todo = [(0, 0)]
        while todo:
            node, depth = todo.pop()
            a, b = lo[node], hi[node]
            if b - a <= leaf:
                continue
            while True:  # down the shared path
                at = self.offsets[a:b] + depth
                inside = depth < self.size[a:b]
                step = np.where(inside, self.path[np.minimum(at, len(self.path) - 1)], -1)
                if step[0] != step[-1] or step[0] < 0:
                    break
                depth += 1
            if step[0] == step[-1]:
                continue  # copies of one vector
            cut = a + np.concatenate(([0], np.flatnonzero(np.diff(step)) + 1, [b - a]))
            held = a
            groups: list[tuple[int, int, bool]] = []
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if y - held > leaf and x > held:
                    groups.append((held, x, False))
                    held = x
                if y - x > leaf:
                    groups.append((x, y, True))
                    held = y
            if held < b:
                groups.append((held, b, False))
            for x, y, further in groups:
                lo.append(x), hi.append(y), parent.append(node)
                self.children.append([])
                self.children[node].append(len(lo) - 1)
                if further:
                    todo.append((len(lo) - 1, depth + 1))
        self.lo, self.hi, self.parent = lo, hi, np.array(parent, np.int64)

    def bound(self, vocabulary: int) -> None:
        """Greatest tf of each term and least m in each subtree; entries in the order of terms."""
        nodes = len(self.lo)
        level = np.zeros(nodes, np.int64)
        for i in range(1, nodes):
            level[i] = level[self.parent[i]] + 1
        leaves = np.array([i for i in range(nodes) if not self.children[i]], np.int64)
        leaves = leaves[np.argsort(np.array(self.lo)[leaves])]
        of = np.repeat(leaves, np.array(self.hi)[leaves] - np.array(self.lo)[leaves])
        self.least = np.full(nodes, NO_ID)
        np.minimum.at(self.least, of, self.m)

        def most(key: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = np.argsort(key, kind="stable")
            key, tf = key[order], tf[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))[:len(key)]
            return key[first], (np.maximum.reduceat(tf, first) if len(key) else tf)

        key, tf = most(np.repeat(of, self.size) * vocabulary + self.terms, self.tfs)
        node = key // vocabulary
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {d: [(key[level[node] == d], tf[level[node] == d])] for d in range(int(level.max()) + 1)}
        out = []
        for d in range(int(level.max()), -1, -1):
            k, t = most(*(np.concatenate(x) for x in zip(*held[d])))
            out.append((k, t))
            on = np.flatnonzero(level == d)
            if d:
                held[d - 1].append((self.parent[k // vocabulary] * vocabulary + k % vocabulary, t))
                np.minimum.at(self.least, self.parent[on], self.least[on])
        key, tf = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(key % vocabulary, kind="stable")
        key, self.node_tf = key[order], tf[order]
        self.node = key // vocabulary
        self.term_at = np.searchsorted(key % vocabulary, np.arange(vocabulary + 1))
        self.gain = gain(self.node_tf, self.least[self.node])


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def lengths(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """m of documents with n terms."""
    if not len(n) or 50 * int(n.max()) * docs < 1 << 62:
        return 100 - 50 + (50 * n * docs) // total
    return np.array([50 + 50 * int(x) * docs // total for x in n], np.int64)


class Best:
    """The k best (score, doc) so far of an item."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.score, self.doc, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        if score.max() < self.least:
            return
        on = score >= self.least
        score, doc, null = (np.concatenate(x) for x in ((self.score, score[on]), (self.doc, doc[on]), (self.null, null[on])))
        first = np.lexsort((doc, null, -score))[:self.k]
        self.score, self.doc, self.null = score[first], doc[first], null[first]
        if len(first) == self.k:
            self.least = int(self.score[-1])


def search(tree: Tree, null: np.ndarray, terms: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: Best) -> int:
    """Depth-first branch and bound for one item; returns the number of leaves that were scored."""
    bounds = np.zeros(len(tree.lo), np.int64)
    for t, w in zip(terms.tolist(), weights.tolist()):
        if w > 0:
            a, b = tree.term_at[t], tree.term_at[t + 1]
            bounds[tree.node[a:b]] += w * tree.gain[a:b]  # a node has one entry of a term
    limit = bounds.tolist()
    dense[terms] = weights
    stack, scored = [0], 0
    while stack:
        node = stack.pop()
        if limit[node] < best.least:
            continue
        children = tree.children[node]
        if children:
            stack += sorted((c for c in children if limit[c] >= best.least), key=limit.__getitem__)
            continue
        scored += 1
        a, b = tree.lo[node], tree.hi[node]
        x, y = tree.offsets[a], tree.offsets[b]
        w = dense[tree.terms[x:y]]
        part = np.zeros(y - x + 1, np.int64)
        np.cumsum(w * tree.parts[x:y], out=part[1:])
        at = tree.offsets[a:b + 1] - x
        best.add(part[at[1:]] - part[at[:-1]], tree.doc[a:b], null[a:b])
    dense[terms] = 0
    return scored


def rank_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
               k: int = 50, block: int = 8192, leaf: int = 32, group_items: int = 2000, group_bytes: int = 16 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item."""
    kind = items.schema[item_id].dataType.simpleString()
    items = saved(items.select(F.col(item_id).alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"),
                               F.monotonically_increasing_id().alias("rid")))
    rows, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    groups = max(1, -(-rows // group_items), -(-size // group_bytes))
    d = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    out = None
    for g in range(groups):
        mine = items.where(F.pmod(F.xxhash64("rid"), F.lit(groups)) == g)
        part = rank_group(d, item_terms(mine, "item", "text"), kind, k, block, leaf)
        out = part if out is None else out.union(part)
    return out.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")


def rank_group(docs: DataFrame, items: list[tuple[object, list[bytes]]], kind: str, k: int, block: int, leaf: int) -> DataFrame:
    """(item, rank, doc, score) of items that were collected."""
    vocabulary = sorted({t for _, terms in items for t in terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    vectors = saved(restricted(docs, vocabulary))
    n_docs, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for t, c in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("c")).toLocalIterator():
        df[t] = c
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    # places of the terms in a path: the most frequent first
    rank = np.argsort(np.lexsort((np.arange(len(df)), -df)))
    asked = [np.array([number[t] for t in terms], np.int64) for _, terms in items]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in asked]
        dense = np.zeros(len(vocabulary), np.int64)
        for whole in it:
            for b in (whole.slice(i, block) for i in range(0, len(whole), block)):
                doc = b.column("doc")
                terms, tfs = (b.column(c).flatten().to_numpy() for c in ("terms", "tfs"))
                offsets = np.concatenate(([0], np.cumsum(b.column("terms").value_lengths().to_numpy())))
                ids = doc.fill_null(NO_ID).to_numpy()
                seated = np.arange(len(b))
                tree = Tree(seated, lengths(b.column("n").to_numpy(), n_docs, total), offsets, terms, tfs, rank, leaf)
                null = doc.is_null().to_numpy(zero_copy_only=False)[tree.doc]
                tree.doc = ids[tree.doc]
                for q, held in zip(asked, best):
                    if len(q):
                        search(tree, null, q, weight[q], dense, held)
        sizes = [len(x.doc) for x in best]
        if sum(sizes):
            doc = pa.array(np.concatenate([x.doc for x in best]), mask=np.concatenate([x.null for x in best]))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(best)), sizes)), doc, pa.array(np.concatenate([x.score for x in best]))],
                                             names=["q", "doc", "score"])

    spark = docs.sparkSession
    tasks = min(vectors.rdd.getNumPartitions(), max(4 * spark.sparkContext.defaultParallelism, n_docs // 100_000))
    found = batches(vectors.coalesce(max(1, tasks)), run, "q long, doc long, score long")
    first = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(items)], f"q long, item {kind}")
    return ranked.join(F.broadcast(names), "q").select("item", "rank", "doc", "score")
