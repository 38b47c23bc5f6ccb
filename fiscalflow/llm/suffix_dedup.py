"""Exact substring dedup by external induced suffix sorting with common-prefix values.

A byte is removed if a ``length``-byte string covering it also starts anywhere else.  Two
suffixes share such a string exactly if their common prefix is at least ``length`` long, so
the work is a suffix order with common-prefix (LCP) values, built in steps whose state lives
on disk:

1. Sampling.  The string at s has one sampled position p: the least hash of a ``gram``-byte
   string inside it, the leftmost of equal ones.  That depends on the string alone, so equal
   strings have equal samples at equal distance.  Starts that share p are one segment, and
   a segment gets two names: the hash of its gram, and the hash of its bytes.
2. Recursion on names.  Segments whose bytes have one name are repeated as a whole; grams with
   a single segment cannot hold a repeat.  Only segments whose gram occurs in other bytes as
   well go on, with one representative of each repeated name to compare with.
3. Induction.  Those are dealt by gram (Spark's external sort is the disk-backed queue) and each
   shard is sorted from its sampled suffixes: first the suffixes at p by their right
   context, with LCP values; then, a byte to the left at a time, the tuple (byte before,
   rank, LCP) of every suffix still queued induces the order of the suffixes one byte
   longer.  An LCP is one more than the least LCP between the two ranks before, or 0 after
   different bytes.  A string at distance a is repeated if a neighbour's LCP reaches
   ``length``; suffixes that can no longer get there leave the queue.
4. A gram with more than ``hot`` different segments would put too many suffixes into one
   shard: its strings are named one by one (128 bits) and counted by partial aggregates.

Memory in a task is bounded by one document, or by ``batch`` + ``hot`` suffixes of at most
2 * ``length`` bytes.

Defined cases: null is the empty text; matches never cross documents; texts shorter than
``length`` lose nothing; repeated rows are copies of each other and lose everything that is
long enough; an empty table gives an empty result; other columns aren't read.  Rows are numbered
and read several times: the numbered rows are saved first, unless the caller says that the input is
``stable``, that is a scan of files, which numbers its rows alike each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm._common import TEXTS, batches, saved

# rows that are cut and given out together
OUT_ROWS = 100
U = np.uint64
TOP = np.iinfo(np.uint64).max
WORD = 1 << 64
RNG = np.random.default_rng(20240607)
BYTE = RNG.integers(0, 2**64, 256, U)
BASE = int(RNG.integers(0, 2**62)) * 4 + 3


class Cache(dict):
    """A dict that is empty again wherever it is sent, so that closures stay small."""

    def __reduce__(self) -> tuple:
        return Cache, ()


_POWERS = Cache()


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    out = _POWERS.get(base, np.ones(1, U))
    while len(out) < n:
        out = np.concatenate([out, out * U(pow(base, len(out), WORD))])
    _POWERS[base] = out
    return out[:n]


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    m = U(0xD6E8FEB86659FD93)
    for _ in range(2):
        x = (x ^ (x >> U(32))) * m
    return x ^ (x >> U(32))


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hash of the ``gram`` bytes at each place."""
    n = len(raw)
    sums = np.zeros(n + 1, U)
    np.cumsum(BYTE[raw] * powers(pow(BASE, -1, WORD), n), out=sums[1:])
    return scrambled((sums[gram:] - sums[:-gram]) * powers(BASE, n - gram + 1))


def window_extremes(x: np.ndarray, w: int, least: bool) -> np.ndarray:
    """Least (or greatest) of each run of ``w`` values."""
    op, fill = (np.minimum, TOP) if least else (np.maximum, U(0))
    m = len(x) - w + 1
    a = np.concatenate([x, np.full(-len(x) % w, fill, U)]).reshape(-1, w)
    ahead = op.accumulate(a, axis=1).ravel()
    behind = op.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[:m], ahead[w - 1:w - 1 + m])


def segments(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, sampled position, gram hash) of each segment of a text."""
    w = length - gram + 1
    h = gram_hashes(np.frombuffer(data, np.uint8), gram)
    low = window_extremes(h, w, True)
    m = len(low)
    # a place is sampled if the greatest of the minima around it is its own hash
    padded = np.concatenate([np.zeros(w - 1, U), low, np.zeros(w - 1, U)])
    sampled = np.nonzero(window_extremes(padded, w, False) == h)[0]
    first = np.concatenate(([0], np.nonzero(low[1:] != low[:-1])[0] + 1))
    last = np.concatenate((first[1:] - 1, [m - 1]))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(first):  # again only where one least hash stands several times
        at = np.searchsorted(sampled, first)
        while len(off := np.nonzero(h[sampled[at]] != low[first])[0]):
            at[off] += 1
        p = sampled[at]
        out.append((first, np.minimum(last, p), p))
        more = last > p
        first, last = p[more] + 1, last[more]
    a, b, p = (np.concatenate(x) for x in zip(*out))
    return a, b, p, h[p]


BITS = 12  # of a distance, packed beside the first start


def segment_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(rid, g, z, pos) of every segment; ``docs``: rid, text.

    pos packs the first start, the distance from it to the sample, and the number of further starts.
    """
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in it:
            rids, gs, zs, ps, held = [], [], [], [], 0
            for rid, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = (t or "").encode()
                if len(data) < length:
                    continue
                a, b, p, g = segments(data, length, gram)
                rids.append(np.full(len(a), rid, np.int64))
                gs.append(g.view(np.int64))
                zs.append(np.fromiter((digest(data[x:y], s) for x, y, s in zip(a.tolist(), (b + length).tolist(), (p - a).tolist())), U, len(a)).view(np.int64))
                ps.append((a << (2 * BITS)) | ((p - a) << BITS) | (b - a))
                held += len(a)
                if held > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (rids, gs, zs, ps)], names=["rid", "g", "z", "pos"])
                    rids, gs, zs, ps, held = [], [], [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (rids, gs, zs, ps)], names=["rid", "g", "z", "pos"])

    return batches(docs, run, "rid long, g long, z long, pos long", TEXTS)


def unpacked(pos: int) -> tuple[int, int, int]:
    """(first start, last start, sample)."""
    mask = (1 << BITS) - 1
    a = pos >> (2 * BITS)
    return a, a + (pos & mask), a + (pos >> BITS & mask)


CONTEXT = "g long, rid long, first long, last long, sample long, partner boolean, left binary, right binary"
CONTEXT_TYPES = pa.schema([("g", pa.int64()), ("rid", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("sample", pa.int64()),
                           ("partner", pa.bool_()), ("left", pa.binary()), ("right", pa.binary())])


def contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the segments to compare, cut at their sample; ``wanted``: rid, g, pos, partner.

    A document's segments are one list, bounded by the document.
    """
    lists = wanted.groupBy("rid").agg(F.collect_list(F.struct("g", "pos", "partner")).alias("want"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            pa.default_memory_pool().release_unused()
            for rid, t, want in zip(b.column("rid").to_pylist(), b.column("text").to_pylist(), b.column("want")):
                data, rows = t.encode(), []
                for w in want.as_py():
                    first, last, p = unpacked(w["pos"])
                    rows.append((w["g"], rid, first, last, p, w["partner"], data[first:p], data[p:last + length]))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(CONTEXT_TYPES.types)], schema=CONTEXT_TYPES)

    # all columns of docs go along, so that its shuffle is the one of the last step too
    return batches(docs.join(lists, "rid"), run, CONTEXT, TEXTS)


def common_prefixes(rows: list[bytes], length: int) -> np.ndarray:
    """LCP of each of the sorted strings with the one before it (0 for the first)."""
    m = len(rows)
    size = np.fromiter(map(len, rows), np.int64, m)
    flat = np.frombuffer(b"".join(r.ljust(length, b"\0") for r in rows), np.uint8).reshape(m, length)
    out = np.zeros(m, np.int64)
    for i in range(1, m, 4096):
        j = min(m, i + 4096)
        differ = flat[i:j] != flat[i - 1:j - 1]
        at = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        out[i:j] = np.minimum(at, np.minimum(size[i:j], size[i - 1:j - 1]))
    return out


def induce(group: np.ndarray, left: list[bytes], right: list[bytes], length: int) -> np.ndarray:
    """repeated[i, a]: the string that starts a bytes before sample i is that of another row of its group.

    ``left``: bytes from the first start to the sample; ``right``: from the sample on.
    """
    m = len(group)
    reach = np.fromiter(map(len, left), np.int64, m)  # the greatest distance of a start
    near = length - np.fromiter(map(len, right), np.int64, m)  # the least
    most = int(reach.max(initial=0))
    # the byte at distance a + 1
    before = np.frombuffer(b"".join(x[::-1].ljust(most + 1, b"\0") for x in left), np.uint8).reshape(m, most + 1)
    repeated = np.zeros((m, most + 1), bool)
    queue = np.array(sorted(range(m), key=lambda i: (group[i], right[i])), np.int64)
    lcp = common_prefixes([right[i] for i in queue], length)
    lcp[np.concatenate(([True], group[queue[1:]] != group[queue[:-1]]))] = 0
    for a in range(most + 1):
        best = np.maximum(lcp, np.concatenate((lcp[1:], [0])))
        hit = queue[(best >= length) & (near[queue] <= a) & (reach[queue] >= a)]
        repeated[hit, a] = True
        # on: rows that have a byte more to the left and can still reach the length
        on = np.nonzero((reach[queue] > a) & (best + most - a >= length))[0]
        if len(on) < 2:
            break
        key = group[queue[on]] * 256 + before[queue[on], a].astype(np.int64)
        rank = on[np.argsort(key, kind="stable")]
        after = np.sort(key, kind="stable")
        same = after[1:] == after[:-1]
        longer = np.zeros(len(rank), np.int64)
        if same.any():
            at = np.nonzero(same)[0]
            cuts = np.stack([rank[at] + 1, rank[at + 1] + 1], axis=1).ravel()
            least = np.minimum.reduceat(np.concatenate((lcp, [0])), cuts)[::2]
            longer[at + 1] = np.minimum(least + 1, length)
        queue, lcp = queue[rank], longer
    return repeated


def runs(repeated: np.ndarray, samples: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, end) of the maximal runs of repeated starts in each row."""
    edge = np.zeros((len(repeated), 1), bool)
    step = np.diff(np.concatenate([edge, repeated, edge], axis=1).astype(np.int8), axis=1)
    row, near = np.nonzero(step == 1)
    _, far = np.nonzero(step == -1)
    return row, samples[row] - (far - 1), samples[row] - near + length


SPAN = "rid long, first long, end long"


def induced_spans(rows: DataFrame, length: int, batch: int) -> DataFrame:
    """Spans (rid, first, end) of repeats among the contexts ``rows``, a gram's rows together."""
    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        group = np.unique(t["g"].to_numpy(), return_inverse=True)[1].astype(np.int64)
        got = induce(group, t["left"].to_pylist(), t["right"].to_pylist(), length)
        got[np.array(t["partner"].to_pylist(), bool)] = False
        row, first, end = runs(got, t["sample"].to_numpy(), length)
        return pa.RecordBatch.from_arrays([pa.array(t["rid"].to_numpy()[row]), pa.array(first), pa.array(end)], names=["rid", "first", "end"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for whole in it:
            for b in (whole.slice(i, batch) for i in range(0, len(whole), batch)):
                g = b.column(0).to_numpy()
                if n >= batch and (g[0] != held[-1].column(0)[-1].as_py() or g[0] != g[-1]):
                    cut = int(np.argmax(g != held[-1].column(0)[-1].as_py()))
                    yield solve([*held, b.slice(0, cut)])
                    held, n, b = [], 0, b.slice(cut)
                    pa.default_memory_pool().release_unused()
                held.append(b)
                n += len(b)
        if n:
            yield solve(held)

    return batches(rows.repartition("g").sortWithinPartitions("g"), run, SPAN)


def named_strings(rows: DataFrame, length: int) -> DataFrame:
    """(x, y, rid, first, partner): the 128-bit name of every string of the contexts."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in it:
            names, at = [], []
            for rid, first, last, partner, left, right in zip(*(b.column(c).to_pylist() for c in ("rid", "first", "last", "partner", "left", "right"))):
                data = left + right
                names += [digest(data[i:i + length]) for i in range(last - first + 1)]
                at += [(rid, first + i, partner) for i in range(last - first + 1)]
            xy = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(xy[:, 0].copy()), pa.array(xy[:, 1].copy()), *(pa.array([r[i] for r in at], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.bool_())))], names=["x", "y", "rid", "first", "partner"])

    return batches(rows, run, "x long, y long, rid long, first long, partner boolean")


def repeated_spans(docs: DataFrame, length: int, gram: int, hot: int, batch: int) -> DataFrame:
    """(rid, first, end) of byte spans that cover all repeats; ``docs``: rid, text and any others."""
    if length - gram + 1 > 1 << BITS:
        raise ValueError(f"length - gram has to be below {1 << BITS}")
    found = saved(segment_rows(docs.select("rid", "text"), length, gram))
    # each smaller side is saved: joined with a bare table, a shuffle of hot grams can be split
    often = saved(found.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("g"))
    found = saved(found.join(often, "g"))
    names = found.groupBy("g", "z").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("r"))
    kinds = saved(found.select("g", "z").distinct().groupBy("g").agg(F.count(F.lit(1)).alias("kinds")))
    known = saved(found.join(saved(names.join(kinds, "g")), ["g", "z"]))
    a = F.shiftright("pos", 2 * BITS)
    whole = known.where("n > 1").select("rid", a.alias("first"), (a + F.col("pos").bitwiseAND((1 << BITS) - 1) + length).alias("end"))
    wanted = known.where("kinds > 1 and (n = 1 or rid = r)").select("rid", "g", "pos", (F.col("n") > 1).alias("partner"), "kinds")
    cool = induced_spans(contexts(docs, wanted.where(F.col("kinds") <= hot), length), length, batch)
    spans = whole.union(cool)
    heated = wanted.where(F.col("kinds") > hot)
    if not heated.isEmpty():
        named = named_strings(contexts(docs, heated, length), length)
        twice = named.groupBy("x", "y").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("x", "y")
        spans = spans.union(named.where("not partner").join(twice, ["x", "y"]).select("rid", "first", (F.col("first") + length).alias("end")))
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans as maximal runs; touching spans are one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400, gram: int = 64, hot: int = 4096,
                   batch: int = 20_000, with_kept: bool = True, stable: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans and, ``with_kept``, kept (the remaining bytes) of every document."""
    d = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    if not stable:
        d = saved(d)
    spans = repeated_spans(d, length, gram, hot, batch).groupBy("rid").agg(F.collect_list(F.struct("first", "end")).alias("found"))
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *["kept"] * with_kept]
    types = [pa.int64()] * 3 + [pa.string(), span, *[pa.binary()] * with_kept]

    def cut(text: str, found: list[dict] | None) -> tuple:
        data = text.encode()
        spans = merged([(s["first"], s["end"]) for s in found or ()])
        kept, at = [], 0
        for x, y in spans:
            kept.append(data[at:x])
            at = y
        rest = b"".join([*kept, data[at:]])
        return (len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), [{"first": x, "end": y} for x, y in spans],
                *[rest] * with_kept)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # few rows at once, as the texts are held twice
        for b in (b.slice(i, OUT_ROWS) for b in it for i in range(0, len(b), OUT_ROWS)):
            rows = [cut(t, found.as_py()) for t, found in zip(b.column("text").to_pylist(), b.column("found"))]
            yield pa.RecordBatch.from_arrays([b.column("doc"), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], names=[doc_id, *names])
            del rows
            pa.default_memory_pool().release_unused()

    kind = d.schema["doc"].dataType.simpleString()
    return batches(d.join(spans, "rid", "left"), run, f"`{doc_id}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                   "spans array<struct<first:bigint,end:bigint>>" + ", kept binary" * with_kept, TEXTS)
