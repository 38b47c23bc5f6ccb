"""SimHash near-duplicates linked through vantage-point trees.

Fingerprints of 64 bits are made from word shingles (XXH64, seed 42, majority a bit).
Distinct fingerprints within ``max_bits`` bits are linked, and documents are classed by the
connected components of the links.

Search: the top of the tree deals fingerprints to shards by their distance to a vantage
value on one block of bits (``max_bits`` + 1 blocks; distance 0, so the shard is the block's
value).  By the pigeonhole rule, two fingerprints within ``max_bits`` bits agree in some block,
so each pair meets in some shard; this is the overlap of the shards' boundaries.  A shard
with more than ``shard_limit`` fingerprints is dealt again by the blocks of its remaining
bits, and what is still larger is cut into tiles whose pairs are tasks of their own.  Inside
a shard a vantage-point tree splits the fingerprints at the median Hamming distance from a
vantage point: by the triangle bound, only those within ``max_bits`` of the split on either
side can link across it.  A vantage point for all 64 bits at the top would not prune: the
distances of unrelated fingerprints lie within a few bits of 32, so most would overlap every
boundary (see the README for figures).

A shard returns a spanning forest of its links, not all pairs; components come from label
rounds on node ids (``_common.connected_components``).

Defined cases: null or wordless text has fingerprint 0, which links like any other; a null
id takes part but is never the component's id unless all are null; repeated rows share a
component; an empty table gives an empty result; texts of fewer words than a shingle are one
shingle of all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm._common import TEXTS, batches, connected_components, saved

BITS = 64
SEED = 42


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of a text as an unsigned 64-bit number."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(w) - words + 1
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[words - 1:].tolist())), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 15):
        bits = np.unpackbits(hashes[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4) -> DataFrame:
    """``docs`` without ``text`` plus ``fp``: the fingerprint as a signed long.

    Columns of ``docs`` that are named like a result (fp, component_id) are replaced."""
    rest = [c for c in docs.columns if c not in (text, "fp", "component_id")]
    d = docs.select(*rest, F.col(text).cast("string"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fp = np.array([fingerprint(t, words) for t in b.column(len(rest)).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp, pa.int64())], names=[*rest, "fp"])

    schema = d.select(*rest, F.lit(0).cast("long").alias("fp")).schema
    return batches(d, run, schema, TEXTS)


def block_bounds(bits: int, blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of each block of 64-bit fingerprints, widths as equal as can be."""
    widths = [bits // blocks + (i < bits % blocks) for i in range(blocks)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def vp_links(fp: np.ndarray, max_bits: int, leaf: int = 4) -> np.ndarray:
    """Component (a position) of each of the distinct fingerprints, by a vantage-point tree.

    A leaf holds at most about ``leaf`` fingerprints, or two branches of a boundary as many pairs.
    """
    forest = Forest(len(fp))
    dist = lambda rows, v: np.bitwise_count(fp[rows] ^ fp[v]).astype(np.int16)

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        for i in range(0, len(a), 256):
            x, y = np.nonzero(np.bitwise_count(fp[a[i:i + 256], None] ^ fp[None, b]) <= max_bits)
            # one link for each row and each column is not enough in general, so all are tried
            for p, q in zip(a[i + x].tolist(), b[y].tolist()):
                if p != q:
                    forest.link(p, q)

    todo: list[tuple[np.ndarray, np.ndarray | None]] = [(np.arange(len(fp)), None)]
    while todo:
        a, b = todo.pop()
        if not len(a) or b is not None and not len(b):
            continue
        if len(a) * len(a if b is None else b) <= leaf * leaf:
            compare(a, a if b is None else b)
            continue
        v = a[0]
        da = dist(a, v)
        cut = int(np.median(da))
        near, far = a[da <= cut], a[da > cut]
        if b is None:
            if not len(far):
                compare(a, a)
                continue
            todo += [(near, None), (far, None), (a[(da <= cut) & (da > cut - max_bits)], a[(da > cut) & (da <= cut + max_bits)])]
        else:
            db = dist(b, v)
            first, second = b[db <= cut + max_bits], b[db > cut - max_bits]
            if len(near) * len(first) + len(far) * len(second) > 0.9 * len(a) * len(b):
                compare(a, b)
                continue
            todo += [(near, first), (far, second)]
    return np.array([forest.root(i) for i in range(len(fp))], np.int64)


def shard_edges(shards: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) inside each shard of (shard, fp), as spanning forests.

    Rows come sorted by shard; a shard cut by an Arrow batch is held until it is whole.
    """
    def solve(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        cuts = np.concatenate(([0], np.nonzero(key[1:] != key[:-1])[0] + 1, [len(key)]))
        none = np.zeros(0, np.uint64)
        us, vs = [none], [none]
        for i in np.nonzero(np.diff(cuts) > 1)[0].tolist():
            part = np.unique(fp[cuts[i]:cuts[i + 1]])
            roots = vp_links(part, max_bits)
            moved = roots != np.arange(len(part))
            us.append(part[moved])
            vs.append(part[roots[moved]])
        u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = [], []
        for b in it:
            if not len(b):
                continue
            key, fp = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
            if held_key and held_key[-1][-1] != key[-1] or not held_key and key[0] != key[-1]:
                cut = int(np.argmax(key == key[-1]))  # where the last shard of the batch begins
                whole_key, whole_fp = np.concatenate([*held_key, key[:cut]]), np.concatenate([*held_fp, fp[:cut]])
                yield solve(whole_key, whole_fp)
                held_key, held_fp = [key[cut:]], [fp[cut:]]
            else:
                held_key.append(key)
                held_fp.append(fp)
        if held_key:
            yield solve(np.concatenate(held_key), np.concatenate(held_fp))

    laid = shards.select("shard", "fp").repartition("shard").sortWithinPartitions("shard")
    return batches(laid, run, "u long, v long")


def deal(fps: DataFrame, max_bits: int, shard_limit: int) -> DataFrame:
    """(shard, fp): every pair within ``max_bits`` bits shares a shard of at most about
    2 * ``shard_limit`` fingerprints.  ``fps``: distinct ``fp``."""
    blocks = max_bits + 1
    named = F.array(*[F.struct(F.lit(i).alias("i"), F.expr(f"shiftrightunsigned(fp, {s}) & {(1 << w) - 1}L").alias("x"))
                      for i, (s, w) in enumerate(block_bounds(BITS, blocks))])
    first = fps.select("fp", F.explode(named).alias("b")).select("fp", F.xxhash64("b.i", "b.x").alias("shard"), F.col("b.i").alias("i"))
    sizes = saved(first.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_limit))
    if sizes.isEmpty():
        return first.select("shard", "fp")
    marked = first.join(sizes, "shard", "left")
    fine = marked.where("n is null").select("shard", "fp")
    # second level: blocks of the bits that the first level has not used
    subs = []
    for i, (s, w) in enumerate(block_bounds(BITS, blocks)):
        low = (1 << s) - 1
        high = f"(shiftrightunsigned(fp, {s + w}) * {1 << s}L)" if s + w < BITS else "0L"
        rest = f"({high} | (fp & {low}L))"
        subs.append((i, [F.struct(F.lit(j).alias("j"), F.expr(f"shiftrightunsigned({rest}, {a}) & {(1 << b) - 1}L").alias("y"))
                         for j, (a, b) in enumerate(block_bounds(BITS - w, blocks))]))
    pick = F.when(F.col("i") == subs[0][0], F.array(*subs[0][1]))
    for i, cols in subs[1:]:
        pick = pick.when(F.col("i") == i, F.array(*cols))
    second = (marked.where("n is not null").select("shard", "fp", F.explode(pick).alias("c"))
              .select(F.xxhash64("shard", "c.j", "c.y").alias("shard"), "fp"))
    again = saved(second.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_limit))
    if again.isEmpty():
        return fine.union(second)
    tiled = second.join(again, "shard", "left")
    t = F.ceil(F.col("n") / F.lit(shard_limit)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit("tile")), t).cast("int")
    tiles = (tiled.where("n is not null").withColumn("t", t).withColumn("own", own)
             .select("shard", "fp", "own", F.explode(F.expr("sequence(0, t - 1)")).alias("other"))
             .select(F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "fp"))
    return fine.union(tiled.where("n is null").select("shard", "fp")).union(tiles)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4,
                    shard_limit: int = 8192) -> DataFrame:
    """One row per document: the columns of ``docs`` but the text, ``fp`` and ``component_id``
    (the least id of the component)."""
    prints = saved(fingerprints(docs, text, words))
    return with_components(prints, doc_id, max_bits, shard_limit)


def with_components(prints: DataFrame, doc_id: str, max_bits: int, shard_limit: int = 8192) -> DataFrame:
    """Adds ``component_id`` to rows that have ``fp``."""
    fps = saved(prints.groupBy("fp").agg(F.min(doc_id).alias("__least")))
    roots = connected_components(shard_edges(deal(fps.select("fp"), max_bits, shard_limit), max_bits))
    named = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "__least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("__least").alias("component_id"))
    by_fp = named.join(ids, "root").select("fp", "component_id")
    return prints.join(by_fp, "fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4, stable: bool = False) -> DataFrame:
    """``docs`` with one row of each component: the one of the least id (the first read of
    equal ones).  The numbered rows are saved, unless ``docs`` is ``stable``: a scan of files."""
    # the columns of docs stay together in a struct, so none can clash
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"))
    if not stable:
        d = saved(d)
    comp = near_duplicates(d.select("row", F.col("doc")[doc_id].alias("id"), F.col("doc")[text].alias("text")), "id", "text", words, max_bits)
    # rows of a component meet in a partial aggregate; components are keyed by their root print
    best = comp.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp_if_null")).agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("best"))
    return d.join(best.select(F.col("best.row").alias("row")), "row").select("doc.*")
