"""Language-model scoring with a class bigram model.

p(w | v) = p(class(w) | class(v)) * p(w | class(w)): class transitions and word emissions,
both smoothed, learned from the training documents and applied to all.

Classes come from exchange clustering, in two steps that move towards a greater likelihood of the class bigrams:

1. Units are clustered on the driver: each unit in turn moves to the best class, sweep after sweep, until none moves.  A unit is
   one of the most frequent words, or the set of all other words that share an ending (the last three bytes, hashed to
   ``endings`` sets).  There are at most (START + endings + 1) ** 2 bigram counts of units.  This gives every word
   a class to begin with, and words that weren't in training their only one.
2. Every training word is then clustered by its own bigrams: its profile, how often each class stands after and before it, is
   counted over all training text, and all words move to their best classes at once, sweep after sweep, from profiles that
   stay on the executors; only sums by class reach the driver.  Neighbours keep the class of step 1 meanwhile.

Transitions and emissions are then counted over the texts in the classes found.

Counts of single words stay distributed.  A task encodes its text in batches of about
``batch`` tokens, each with a dictionary of its own; only dictionaries (a row for each
word of a batch) are joined with counts and classes of the corpus, which are sent back to the
batch.  Documents are saved as the classes of their tokens.  Memory is bounded by a batch plus ROWS documents.

Emissions: (c + 0.1) / (N_k + 0.1 * (V_k + 1)) for a word with training count c in class k with
N_k tokens and V_k words; the extra slot is what class k gives to unseen words.  Transitions:
(n(j, k) + a * p(k)) / (n(j) + a), where p(k) is the add-one share of class k.

Defined cases: null is the empty text, which has the end token alone; a null id counts as the
empty text for the split; without training documents all counts are 0; repeated rows are
scored and learned from as often as they stand; an empty table gives an empty result; other
columns aren't read.  Batches are named by row number as read, so the input has to be a table
or file scan.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm._common import batches, shared_dir
from fiscalflow.session import FREED, STAGED, remove_folder, settings

END = b" "  # no word has a space
ADD = 0.1
ROWS = 100    # documents turned into words at once
START = 768   # most frequent words among the units, from whose classes the clustering of all words begins


def held_out(doc_id: Column, folds: int = 10) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def encoded(it: Iterator[pa.RecordBatch], batch: int, only_training: bool) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray, pa.Array]]:
    """Batches of documents (id, row, held, text) of about ``batch`` tokens: their columns but the text, token numbers, where
    each document starts, and the words (the end token is the last)."""
    rows, flat, sizes, n = [], [], [], 0

    def close() -> tuple[list[tuple], np.ndarray, np.ndarray, pa.Array]:
        coded = pa.concat_arrays(flat).dictionary_encode()
        words = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
        size = np.concatenate(sizes)
        ids = np.full(len(coded) + len(size), len(words) - 1, np.int32)
        ids[np.arange(len(coded)) + np.repeat(np.arange(len(size)), size)] = coded.indices.to_numpy()
        return rows, ids, np.concatenate(([0], np.cumsum(size + 1)[:-1])), words

    for b in it:
        if only_training:
            b = b.filter(pc.invert(b.column(2)))
        if not len(b):
            continue
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(b.column(3).cast(pa.string()), "")))
        words, ends = split.flatten(), split.offsets.to_numpy()
        some = pc.greater(pc.binary_length(words), 0)   # white space at an end leaves an empty piece
        before = np.concatenate(([0], np.cumsum(some.to_numpy(zero_copy_only=False))))
        flat.append(words.filter(some))
        sizes.append(np.diff(before[ends - ends[0]]))
        rows.extend(zip(*(b.column(i).to_pylist() for i in range(3))))
        n += len(flat[-1]) + len(b)
        if n >= batch:
            yield close()
            rows, flat, sizes, n = [], [], [], 0
    if n:
        yield close()


def unit_of(word: bytes, top: dict[bytes, int], endings: int) -> int:
    """0 is the end token, then the top words, then the endings."""
    return top.get(word) or len(top) + 1 + zlib.crc32(word[-3:]) % endings


def top_units(words: list[bytes]) -> dict[bytes, int]:
    """Unit of each frequent word; the end token isn't one of them."""
    return {w: i + 1 for i, w in enumerate(w for w in words if w != END)}


def units_of(words: pa.Array, top: dict[bytes, int], endings: int) -> np.ndarray:
    return np.fromiter((0 if w == END else unit_of(w, top, endings) for w in words.to_pylist()), np.int64, len(words))


def word_counts(docs: DataFrame, batch: int) -> DataFrame:
    """(word, c) over the training rows of docs (id, row, held, text)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, _, words in encoded(it, batch, True):
            n = np.bincount(ids, minlength=len(words))
            for i in range(0, len(words), 200_000):
                yield pa.RecordBatch.from_arrays([words[i:i + 200_000], pa.array(n[i:i + 200_000])], names=["word", "n"])

    return batches(docs, run, "word binary, n long", ROWS).groupBy("word").agg(F.sum("n").alias("c"))


def unit_bigrams(docs: DataFrame, top: dict[bytes, int], endings: int, batch: int) -> np.ndarray:
    """Matrix of unit bigram counts of the training rows; a text begins after an end token."""
    size = len(top) + endings + 1

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for _, ids, starts, words in encoded(it, batch, True):
            u = units_of(words, top, endings)[ids]
            # every text ends with unit 0, which is what the next one begins after
            total += np.bincount(np.concatenate(([0], u[:-1])) * size + u, minlength=size * size)
        at = np.nonzero(total)[0]
        for i in range(0, len(at), 200_000):
            k = at[i:i + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], names=["k", "n"])

    rows = batches(docs, run, "k long, n long", ROWS).groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[rows["k"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(size, size)


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Class (1 to ``classes``; the end's is 0) of each unit by exchange clustering.

    Units begin dealt out in the order of their counts.
    """
    u = len(bigrams)
    order = np.argsort(-bigrams.sum(axis=0), kind="stable")
    order = order[order != 0]
    cls = np.zeros(u, np.int64)
    cls[order] = 1 + np.arange(u - 1) % classes
    member = np.eye(classes + 1)[cls]
    n = member.T @ bigrams @ member
    for _ in range(sweeps):
        moved = 0
        for x in order:
            ahead, back, own = bigrams[x] @ member, bigrams[:, x] @ member, bigrams[x, x]
            if not ahead.any() and not back.any():
                continue
            a = cls[x]
            ahead[a] -= own
            back[a] -= own
            n[a] -= ahead
            n[:, a] -= back
            n[a, a] -= own
            left, right = n.sum(axis=1), n.sum(axis=0)
            diagonal = np.diag(n)
            gain = (xlogx(n + ahead) - xlogx(n)).sum(axis=1) + (xlogx(n + back[:, None]) - xlogx(n)).sum(axis=0)
            gain -= xlogx(diagonal + ahead) + xlogx(diagonal + back) - xlogx(diagonal)
            gain += xlogx(diagonal + ahead + back + own)
            gain -= xlogx(left + ahead.sum() + own) - xlogx(left) + xlogx(right + back.sum() + own) - xlogx(right)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            n[b] += ahead
            n[:, b] += back
            n[b, b] += own
            if b != a:
                cls[x] = b
                member[x] = 0
                member[x, b] = 1
                moved += 1
        if not moved:
            break
    return cls


class Start:
    """Classes of the units: where the clustering of words begins, and the class of a word that wasn't in training."""

    def __init__(self, bigrams: np.ndarray, top: dict[bytes, int], endings: int, classes: int, sweeps: int):
        self.top, self.endings = top, endings
        self.cls = exchange(bigrams, classes, sweeps).astype(np.int16)
        member = np.eye(classes + 1)[self.cls]
        self.bigrams = member.T @ bigrams @ member

    def of(self, words: pa.Array) -> np.ndarray:
        return self.cls[units_of(words, self.top, self.endings)]


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.options(**STAGED).parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


# --- every training word is clustered by its own bigrams ---------------------------------

ENTRY = np.dtype([("k", "<u2"), ("n", "<u4")])   # of a profile: class after the word, or classes + 1 + class before it, and how often


def packed(words: pa.Array, owner: np.ndarray, k: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """(word, profile): the entries (k, n) of each word, sorted by ``owner``, its number."""
    entries = np.empty(len(k), ENTRY)
    entries["k"], entries["n"] = k, n
    ends = np.searchsorted(owner, np.arange(len(words) + 1)).astype(np.int32) * ENTRY.itemsize
    return pa.RecordBatch.from_arrays([words, pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(entries)])], names=["word", "profile"])


def unpacked(profiles: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, k, n) of all entries."""
    _, ends, data = profiles.buffers()
    ends = np.frombuffer(ends, np.int32, len(profiles) + 1, 4 * profiles.offset) if ends else np.zeros(1, np.int32)
    size = np.diff(ends) // ENTRY.itemsize
    entries = np.frombuffer(data, ENTRY, size.sum(), ends[0]) if size.any() else np.empty(0, ENTRY)
    return np.repeat(np.arange(len(size)), size), entries["k"].astype(np.int64), entries["n"].astype(np.int64)


def word_profiles(docs: DataFrame, start: Start, batch: int) -> DataFrame:
    """(word, profile) of every training word but the end: how often each class stands after and before it."""
    size = int(start.cls.max(initial=0)) + 1

    def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, _, words in encoded(it, batch, True):
            cls = start.of(words)[ids].astype(np.int64)
            at = np.nonzero(ids != len(words) - 1)[0]
            own = ids[at].astype(np.int64) * (2 * size)
            # every text ends with class 0, which is what the next one begins after
            key, n = np.unique(np.concatenate((own + cls[at + 1], own + size + np.where(at > 0, cls[at - 1], 0))), return_counts=True)
            owner = key // (2 * size)
            for i in range(0, len(words) - 1, 100_000):
                z = min(i + 100_000, len(words) - 1)
                a, b = np.searchsorted(owner, (i, z))
                yield packed(words[i:z], owner[a:b] - i, key[a:b] % (2 * size), n[a:b])

    def merged(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None   # the last word may go on
        for b in it:
            b = pa.RecordBatch.from_arrays([b.column(0).cast(pa.binary()), b.column(1).cast(pa.binary())], names=["word", "profile"])
            if kept is not None:
                b = pa.concat_batches([kept, b])
            if not len(b):
                continue
            new = np.concatenate(([True], pc.not_equal(b.column(0)[1:], b.column(0)[:-1]).to_numpy(zero_copy_only=False)))
            row, k, n = unpacked(b.column(1))
            key = (np.cumsum(new) - 1)[row] * (2 * size) + k
            order = np.argsort(key, kind="stable")
            key, first = np.unique(key[order], return_index=True)
            out = packed(b.column(0).filter(pa.array(new)), key // (2 * size), key % (2 * size), np.add.reduceat(n[order], first) if len(first) else n)
            kept = out.slice(len(out) - 1)
            if len(out) > 1:
                yield out.slice(0, len(out) - 1)
        if kept is not None:
            yield kept

    rows = batches(docs, counted, "word binary, profile binary", ROWS)
    return batches(rows.repartition("word").sortWithinPartitions("word"), merged, "word binary, profile binary")


class Sums:
    """What a sweep needs of each class: counts of classes after and before its words (by fixed classes of the neighbours)."""

    def __init__(self, after: np.ndarray, before: np.ndarray):
        self.size = len(after)
        self.tokens = after.sum(axis=1)
        # what a word's profile is multiplied with, by class
        self.worth = np.log(np.concatenate((after, before), axis=1) + ADD).T
        # the end's own class, and empty ones, which all words would enter together
        self.closed = (self.tokens == 0) | (np.arange(self.size) == 0)

    def best(self, profiles: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Class of greatest likelihood of each word, that likelihood, its profile as a row, and its count."""
        row, k, n = unpacked(profiles)
        dense = np.bincount(row * (2 * self.size) + k, n, len(profiles) * 2 * self.size).reshape(-1, 2 * self.size)
        count = dense[:, :self.size].sum(axis=1)
        gain = dense @ self.worth - 2 * count[:, None] * np.log(self.tokens + ADD)
        gain[:, self.closed] = -np.inf
        cls = gain.argmax(axis=1)
        return cls, gain[np.arange(len(cls)), cls], dense, count


def parts_of(profiles: pa.Array) -> Iterator[pa.Array]:
    return (profiles.slice(i, 5000) for i in range(0, len(profiles), 5000))


def alike(profiles: DataFrame) -> DataFrame:
    """(profile, words): words of the same profile, such as most that occur once, go to the same class."""
    return profiles.groupBy("profile").agg(F.count(F.lit(1)).alias("words"))


def swept(alikes: DataFrame, sums: Sums) -> tuple[Sums, float]:
    """All words moved to their best classes at once: the new sums, and the likelihood by the old ones."""
    size = sums.size

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, likelihood = np.zeros((size, 2 * size)), 0.0
        for b in it:
            for i, part in enumerate(parts_of(b.column(0).cast(pa.binary()))):
                cls, gain, dense, _ = sums.best(part)
                words = b.column(1).to_numpy()[5000 * i:5000 * i + len(part)]
                likelihood += gain @ words
                total += (np.eye(size)[cls] * words[:, None]).T @ dense
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size + 1)), pa.array(np.append(total, likelihood))], names=["k", "n"])

    rows = batches(alikes, run, "k long, n double").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(2 * size * size + 1)
    out[rows["k"].to_numpy()] = rows["n"].to_numpy()
    return Sums(*np.split(out[:-1].reshape(size, 2 * size), 2, axis=1)), float(out[-1])


def clustered(alikes: DataFrame, start: Start, sweeps: int) -> Sums:
    """Sweeps from the classes of the units on, until the likelihood rises by less than a ten-thousandth."""
    sums, before = Sums(start.bigrams, start.bigrams.T), -np.inf
    for _ in range(sweeps):
        sums, now = swept(alikes, sums)
        if now - before <= 1e-4 * abs(now):
            break
        before = now
    return sums


def words_by_class(profiles: DataFrame, sums: Sums) -> DataFrame:
    """(word, c, cls) of every training word but the end."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = [sums.best(part) for part in parts_of(b.column(1).cast(pa.binary()))]
            if found:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate([x[3] for x in found]).astype(np.int64)),
                                                  pa.array(np.concatenate([x[0] for x in found]).astype(np.int16))], names=["word", "c", "cls"])

    return batches(profiles, run, "word binary, c long, cls short")


def words_by_unit(counts: DataFrame, start: Start) -> DataFrame:
    """(word, c, cls) of every training word, by the class of its unit."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(start.of(b.column(0)), pa.int16())], names=["word", "c", "cls"])

    return batches(counts, run, "word binary, c long, cls short")


# --- scores -------------------------------------------------------------------------------

def encoded_parts(docs: DataFrame, start: Start, batch: int) -> DataFrame:
    """Rows of two kinds: words of a batch (lid, word, cls: as if it wasn't in training), and its documents (id, held, tokens = numbers of its words)."""
    names, kind = [docs.columns[0], "batch", "lid", "word", "cls", "held", "tokens"], docs.schema[0].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        type_ = None

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal type_
            for b in it:
                type_ = b.schema[0].type
                yield b

        for rows, ids, starts, words in encoded(watched(), batch, False):
            k = rows[0][1]  # the batch goes by its first row
            cls = start.of(words)
            for i in range(0, len(words), 100_000):
                w = words[i:i + 100_000]
                m = len(w)
                yield pa.RecordBatch.from_arrays([pa.nulls(m, type_), pa.array(np.full(m, k)), pa.array(np.arange(i, i + m, dtype=np.int32)), w,
                                                  pa.array(cls[i:i + m], pa.int16()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.binary())], names=names)
            ends = np.concatenate((starts[1:], [len(ids)]))
            for i in range(0, len(rows), 2000):
                part = rows[i:i + 2000]
                m = len(part)
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in part], type_), pa.array(np.full(m, k)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int16()),
                    pa.array([r[2] for r in part], pa.bool_()), pa.array([ids[a:z].tobytes() for a, z in zip(starts[i:i + m], ends[i:i + m])], pa.binary())], names=names)

    return batches(docs, run, f"`{docs.columns[0]}` {kind}, batch long, lid int, word binary, cls short, held boolean, tokens binary", ROWS)


def grown(a: np.ndarray, size: int) -> np.ndarray:
    return a if size <= len(a) else np.concatenate([a, np.zeros(max(size, 2 * len(a)) - len(a), a.dtype)])


def in_classes(parts: DataFrame, words: DataFrame) -> DataFrame:
    """(id, held_out, n_tokens, n_known, emissions, classes) of the documents in ``parts``, whose words get count and class from ``words``:
    ``emissions`` is the sum of log10(c + ADD), ``classes`` the class of each token."""
    doc_id, kind = parts.columns[0], parts.schema[0].dataType
    known = words.select("word", "c", F.col("cls").alias("__cls"))
    none = F.lit(None)
    both = parts.where("lid is not null").select("batch", "lid", "word", "cls").join(known, "word", "left").select(
        "batch", none.cast(kind).alias(doc_id), "lid", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("__cls", "cls").alias("cls"),
        none.cast("boolean").alias("held"), none.cast("binary").alias("tokens")).union(
        parts.where("lid is null").select("batch", doc_id, "lid", none.cast("long").alias("c"), "cls", "held", "tokens"))
    laid = both.repartition("batch").sortWithinPartitions("batch", F.col("lid").isNull())
    fields = [("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("emissions", pa.float64()), ("classes", pa.binary())]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts, classes = None, np.zeros(0, np.int64), np.zeros(0, np.int16)
        for b in it:
            key, lid, c, cls = b.column(0).to_numpy(), b.column(2), b.column(3), b.column(4)
            cuts = np.concatenate(([0], np.nonzero(key[1:] != key[:-1])[0] + 1, [len(key)])) if len(key) else [0]
            for x, y in zip(cuts[:-1], cuts[1:]):
                if key[x] != now:
                    now, counts, classes = key[x], np.zeros(0, np.int64), np.zeros(0, np.int16)
                ids = lid.slice(x, y - x).drop_null().to_numpy()
                if len(ids):
                    counts, classes = grown(counts, int(ids.max()) + 1), grown(classes, int(ids.max()) + 1)
                    counts[ids] = c.slice(x, len(ids)).to_numpy()
                    classes[ids] = cls.slice(x, len(ids)).to_numpy()
                docs = b.slice(x + len(ids), y - x - len(ids))
                rows = []
                for held, tokens in zip(docs.column(5).to_pylist(), docs.column(6).to_pylist()):
                    t = np.frombuffer(tokens, np.int32)
                    seen = counts[t]
                    rows.append((held, len(t), int((seen > 0).sum()), float(np.log10(seen + ADD).sum()), classes[t].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([docs.column(1), *(pa.array([r[i] for r in rows], f[1]) for i, f in enumerate(fields))], names=[doc_id, *(f[0] for f in fields)])

    return batches(laid, run, f"`{doc_id}` {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, emissions double, classes binary")


def class_bigrams(docs: DataFrame, size: int) -> np.ndarray:
    """Matrix of class bigram counts of the training documents; a text begins after an end token."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for b in it:
            cls = np.frombuffer(b"".join(b.column(0).to_pylist()), np.int16).astype(np.int64)
            total += np.bincount(np.concatenate(([0], cls[:-1])) * size + cls, minlength=size * size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total)], names=["k", "n"])

    rows = batches(docs.where("not held_out").select("classes"), run, "k long, n long", ROWS).groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[rows["k"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(size, size)


def summed(docs: DataFrame, bigrams: np.ndarray, types: np.ndarray, n: int, v: int, weight: float = 1.0) -> DataFrame:
    """Scores of documents (from ``in_classes``) by class transitions and emissions."""
    tokens = bigrams.sum(axis=0)
    share = (tokens + 1) / (tokens + 1).sum()
    transition = np.log10((bigrams + weight * share) / (bigrams.sum(axis=1, keepdims=True) + weight))
    worth = transition - np.log10(tokens + ADD * (types + 1))
    total = np.log10(n + ADD * (v + 1))
    doc_id, kind = docs.columns[0], docs.schema[0].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            classes = [np.frombuffer(c, np.int16) for c in b.column(5).to_pylist()]
            add, size = b.column(4).to_numpy(), b.column(2).to_numpy()
            tail = np.array([worth[np.concatenate(([0], c[:-1])), c].sum() for c in classes])
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(np.full(len(b), n, np.int64)), pa.array(add - size * total), pa.array(add + tail, pa.float64())],
                                             names=[doc_id, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return batches(docs, run, f"`{doc_id}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", ROWS)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", top: int | None = None, endings: int = 256, classes: int = 32, sweeps: int = 10,
          batch: int = 2_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every
    document; perplexity is 10 ** (-score / n_tokens).

    Every training word is clustered by its own bigrams.  ``top``: the bounded model instead, in which all words beyond
    the ``top`` most frequent ones have the class of their ending.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id), F.monotonically_increasing_id().alias("__row"), held_out(F.col(doc_id)).alias("__held"),
                    F.col(text).cast("string").alias("__text"))
    folder = f"{shared_dir(spark)}/class-bigrams/{uuid.uuid4().hex}"
    with settings(spark, FREED):
        counts = written(word_counts(d, batch), folder, "made/counts")
        n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        frequent = top_units([bytes(r["word"]) for r in counts.orderBy(F.desc("c"), "word").limit(top or START).collect()])
        start = Start(unit_bigrams(d, frequent, endings, batch), frequent, endings, classes, sweeps)
        if top:
            words = words_by_unit(counts, start)
        else:
            profiles = written(word_profiles(d, start, batch), folder, "made/profiles")
            ends = counts.where(F.col("word") == F.lit(END)).select("word", "c", F.lit(0).cast("short").alias("cls"))
            alikes = written(alike(profiles), folder, "made/alike")
            words = words_by_class(profiles, clustered(alikes, start, sweeps)).union(ends)
        words = written(words, folder, "made/words")
        types = np.zeros(classes + 1)
        for r in words.groupBy("cls").count().collect():
            types[r["cls"]] = r["count"]
        found = written(in_classes(encoded_parts(d, start, batch), words), folder, "documents")
        bigrams = class_bigrams(found, classes + 1)
    remove_folder(spark, f"{folder}/made")
    return summed(found, bigrams, types, n, v)
