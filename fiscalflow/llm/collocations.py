"""Phrase collocations by Rabin-Karp fingerprints of n-grams.

1. Fingerprints.  Prefix polynomials over bytes hash every word, prefix polynomials over the words of a
   piece hash every n-gram of 1 to ``max_words`` words.  A task counts fingerprints of ``hold``
   n-grams by sorting.  They are dealt by hash to parts, a row a part with its fingerprints and counts as arrays;
   the number of parts follows the size of all texts, so that a part stays as small at any size.
2. Frequent ones.  Fingerprints counted ``least`` times or more set a bit each in a table of
   ``filter_bits`` bits, the only thing that is broadcast.  A table that gets full lets rarer n-grams
   through to step 3, where they cost a shuffle and nothing else; set more bits for more text.
3. Verification.  A second pass looks only at n-grams whose bit is set.  Those of one fingerprint in a
   task are compared with its first occurrence word by word (by exact word numbers); what differs is a
   group of its own.  Each group has the phrase as text, its count, and a pointer to its first
   occurrence (document, byte); a task adds them up and writes a row for each lang and part, phrases in order.  Parts
   are added up by text, so that counts are exact whatever collides: a phrase that occurs ``least`` times
   can't have a rarer fingerprint.
4. Scores.  Each candidate is cut after each of its words, the parts' counts are joined (parts are at
   least as frequent), and the lowest score is kept.  Candidates inside a longer one that
   accounts for ``covered`` percent of them are dropped.  Arithmetic is decimal, so it is exact.

Occurrences never meet in one place: hot phrases are counted in each task before every shuffle, and
the parts of phrases are joined by shuffles that Spark can split.  Memory in a task is bounded by
``hold`` fingerprints and a chunk of texts, or one document.

Defined cases: null text is empty, null lang is ``und``; phrases never cross pieces or documents; repeated
rows are counted each; an empty table gives an empty result; other columns aren't read.  A null
doc_id is no pointer; of a repeated doc_id the byte is that of one of its rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalflow.llm._common import batches, saved, small
from fiscalflow.llm._words import U, Words, chunks, kinds, numbered, powers, scrambled, split
from fiscalflow.llm.suffix_dedup import WORD

TABLE = kinds([0x20, 0x09], [*b".,;:!?", *range(0x0A, 0x0E)])
STEP = 0x9E3779B97F4A7C15  # odd base of the polynomials over words
BLOCK = 1 << 15  # bits of one bitmap_construct_agg


def fingerprints(words: Words, langs: list[str], max_words: int, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, first words, fingerprints) of all n-grams; ``langs``: of each text."""
    seed = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], U)[words.doc]
    m = len(words)
    sums = np.zeros(m + 1, U)
    np.cumsum(words.hashes() * powers(pow(STEP, -1, WORD), m), out=sums[1:])
    up = powers(STEP, m)
    for n in range(1, min(max_words, m) + 1):
        first = np.flatnonzero((words.piece[n - 1:] == words.piece[:m - n + 1]) & (words.doc[n - 1:] == words.doc[:m - n + 1]))
        h = scrambled((sums[first + n] - sums[first]) * up[first] + seed[first] + U(n))
        yield n, first, h if bits == 64 else scrambled(h >> U(64 - bits))


def seat(h: np.ndarray, parts: int) -> np.ndarray:
    """The counted form of fingerprints: the part in the upper, half of the fingerprint in the lower 32 bits."""
    return ((h >> U(32)) * U(parts) >> U(32)) << U(32) | h & U(0xFFFFFFFF)


def slot(seats: np.ndarray, filter_bits: int) -> np.ndarray:
    """The bit of a counted fingerprint."""
    return (scrambled(seats) & U(filter_bits - 1)).astype(np.int64)


def packed(*columns: np.ndarray) -> bytes:
    """Integer columns of one length as compressed bytes; equal high bytes take next to nothing."""
    flat = np.stack(columns).astype("<i8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(flat).tobytes())


def unpacked(data: bytes, columns: int) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(flat.T).view("<i8").reshape(columns, -1)


def counted(h: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row for each part: the steps between its fingerprints in order, and their counts."""
    s, c = np.unique(seat(h, parts), return_counts=True)
    part = (s >> U(32)).astype(np.int32)
    cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    ends = [*cut[1:].tolist(), len(s)]
    low = (s & U(0xFFFFFFFF)).astype(np.int64)
    step = np.diff(low, prepend=0)
    step[cut] = low[cut]
    data = [packed(step[x:y], c[x:y]) for x, y in zip(cut.tolist(), ends)]
    return pa.RecordBatch.from_arrays([pa.array(part[cut]), pa.array(data, pa.binary())], names=["part", "data"])


def frequent_bits(docs: DataFrame, max_words: int, least: int, bits: int, hold: int, parts: int, filter_bits: int) -> DataFrame:
    """bit: of every fingerprint that is counted ``least`` times; ``docs``: doc, lang, text."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in chunks(it):
            for _, _, h in fingerprints(split(b.column("text"), TABLE), b.column("lang").to_pylist(), max_words, bits):
                held.append(h)
                n += len(h)
                if n >= hold:
                    yield counted(np.concatenate(held), parts)
                    held, n = [], 0
        if n:
            yield counted(np.concatenate(held), parts)

    def add(group: pa.Table) -> pa.Table:
        rows = [unpacked(x, 2) for x in group["data"].to_pylist()]
        fps = np.concatenate([np.cumsum(x[0]) for x in rows])
        counts = np.concatenate([x[1] for x in rows])
        order = np.argsort(fps, kind="stable")
        fps, counts = fps[order], counts[order]
        head = np.flatnonzero(np.concatenate(([True], fps[1:] != fps[:-1])))
        often = fps[head[np.add.reduceat(counts, head, dtype=np.int64) >= least]]
        return pa.table({"bit": slot(U(group["part"][0].as_py()) << U(32) | often.astype(U), filter_bits)})

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return batches(docs, run, "part int, data binary").groupBy("part").applyInArrow(add, "bit long")


def bit_table(bits: DataFrame, filter_bits: int) -> np.ndarray:
    """The table in which each ``bit`` is set; filter_bits / 8 bytes on the driver."""
    parts = bits.groupBy(F.shiftright("bit", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(BLOCK - 1)).alias("bits"))
    out = np.zeros((filter_bits // BLOCK, BLOCK // 8), np.uint8)
    for r in parts.toLocalIterator():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def exact_groups(words: Words, lang: np.ndarray, n: int, first: np.ndarray, h: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first words of the first occurrences, counts, fingerprints) of n-grams that are equal in lang and all words."""
    while len(first):
        order = np.argsort(h, kind="stable")
        first, h = first[order], h[order]
        new = np.concatenate(([True], h[1:] != h[:-1]))
        head = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        rep = first[head][group]
        same = lang[words.doc[first]] == lang[words.doc[rep]]
        for j in range(n):
            same &= number[first + j] == number[rep + j]
        yield first[head], np.bincount(group[same], minlength=len(head)), h[head]
        first, h = first[~same], h[~same]


NO_DOC = np.iinfo(np.int64).max
PACKED = "lang string, part int, phrases binary, numbers binary"


@dataclass
class Found:
    """Phrases of one lang with their part, count and first occurrence (document, byte)."""
    phrase: pa.Array
    part: np.ndarray
    c: np.ndarray
    doc: np.ndarray
    at: np.ndarray

    def added(self) -> Found:
        """Each phrase once."""
        coded = self.phrase.dictionary_encode()
        code = coded.indices.to_numpy()
        order = np.lexsort((self.at, self.doc, code))
        code = code[order]
        head = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))[:len(code)]
        c = np.add.reduceat(self.c[order], head) if len(head) else self.c
        first = order[head]
        return Found(coded.dictionary, self.part[first], c, self.doc[first], self.at[first])

    @staticmethod
    def of(all_of: list[Found]) -> Found:
        return Found(pa.concat_arrays([x.phrase for x in all_of]), *(np.concatenate([getattr(x, k) for x in all_of]) for k in ("part", "c", "doc", "at")))

    def packed(self, lang: str) -> pa.RecordBatch:
        """A row for each part; phrases in order, joined by line feeds, which no phrase has."""
        order = pc.sort_indices(pa.table({"part": self.part, "phrase": self.phrase}), [("part", "ascending"), ("phrase", "ascending")]).to_numpy()
        phrase, part = self.phrase.take(pa.array(order)).to_pylist(), self.part[order]
        cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        offsets = np.concatenate((cut, [len(part)])).astype(np.int32)
        ends = [*cut[1:].tolist(), len(part)]
        texts = [zstandard.ZstdCompressor(level=1).compress(b"\n".join(phrase[x:y])) for x, y in zip(cut.tolist(), ends)]
        columns = [self.c[order], self.doc[order], self.at[order]]
        numbers = [packed(*(v[x:y] for v in columns)) for x, y in zip(cut.tolist(), ends)]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(cut)), pa.array(part[cut].astype(np.int32)), pa.array(texts, pa.binary()), pa.array(numbers, pa.binary())],
                                          names=["lang", "part", "phrases", "numbers"])


def phrase_counts(docs: DataFrame, table: np.ndarray, max_words: int, bits: int, parts: int, least: int, hold: int) -> DataFrame:
    """(lang, phrase, words, c, doc, at) of every n-gram whose bit is set and that is counted ``least`` times,
    and the number of words (words: 0) of every lang.

    A task adds up the phrases of about ``hold`` n-grams before it writes them.
    """
    filter_bits = len(table) * 8
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def found(b: pa.RecordBatch) -> Iterator[tuple[str, Found]]:
        # so that the first occurrence is that of the least document
        b = b.sort_by("doc") if len(b) > 1 else b
        docs = b.column("doc").fill_null(NO_DOC).to_numpy()
        langs = b.column("lang").to_pylist()
        names = sorted(set(langs))
        number_of = {x: i for i, x in enumerate(names)}
        lang = np.array([number_of[x] for x in langs])
        w = split(b.column("text"), TABLE)
        if not len(w):
            return
        for i, c in enumerate(np.bincount(lang[w.doc], minlength=len(names))):
            yield names[i], Found(pa.array([b""], pa.binary()), np.zeros(1, np.int64), np.array([c]), np.array([NO_DOC]), np.zeros(1, np.int64))
        number = numbered(w)
        for n, first, h in fingerprints(w, langs, max_words, bits):
            s = seat(h, parts)
            bit = slot(s, filter_bits)
            on = (shared.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            for head, c, of in exact_groups(w, lang, n, first[on], s[on], number):
                mine = lang[w.doc[head]]
                for i in np.unique(mine).tolist():
                    x = head[mine == i]
                    yield names[i], Found(w.slices(x, x + n - 1), (of[mine == i] >> U(32)).astype(np.int64), c[mine == i], docs[w.doc[x]], w.at[x])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[Found]] = {}
        n = 0
        for b in chunks(it):
            for lang, x in found(b):
                held.setdefault(lang, []).append(x)
                n += len(x.c)
            if n >= hold:
                held = {k: [Found.of(x).added()] for k, x in held.items()}
                n = sum(len(x[0].c) for x in held.values())
                if 2 * n >= hold:
                    yield from (x[0].packed(k) for k, x in held.items())
                    held, n = {}, 0
        yield from (Found.of(x).added().packed(k) for k, x in held.items())

    def add(key: tuple, group: pa.Table) -> pa.Table:
        texts = [zstandard.ZstdDecompressor().decompress(x) for x in group["phrases"].to_pylist()]
        phrase = pa.array(b"\n".join(texts).split(b"\n"), pa.binary())
        c, doc, at = np.concatenate([unpacked(x, 3) for x in group["numbers"].to_pylist()], axis=1)
        x = Found(phrase, np.zeros(len(c), np.int64), c, doc, at).added()
        on = (x.c >= least) | (pc.binary_length(x.phrase).to_numpy(zero_copy_only=False) == 0)
        phrase = x.phrase.filter(pa.array(on))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(phrase), pa.string()), "phrase": phrase, "c": x.c[on],
                         "doc": pa.array(x.doc[on], mask=x.doc[on] == NO_DOC), "at": x.at[on]})

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    out = batches(docs, run, PACKED).groupBy("lang", "part").applyInArrow(add, "lang string, phrase binary, c long, doc long, at long")
    phrase = F.col("phrase").cast("string")
    return out.select("lang", phrase.alias("phrase"), F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " "))).alias("words"), "c", "doc", "at")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of every candidate by its lowest-scoring cut; ``counts``: saved."""
    part = F.split("phrase", " ")
    cuts = (counts.where("words > 1").drop("doc", "at").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumn("__part", part)
            .withColumn("left", F.array_join(F.slice("__part", F.lit(1), F.col("k")), " "))
            .withColumn("right", F.array_join(F.slice("__part", F.col("k") + 1, F.col("words") - F.col("k")), " ")).drop("__part"))
    f = counts.where("words > 0")
    cuts = saved(cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("c").alias("l")), ["lang", "left"]))
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("right"), F.col("c").alias("r")), ["lang", "right"])
    wide = [F.col(x).cast("decimal(19,0)") for x in "clr"]
    cuts = cuts.withColumn("top", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("base", wide[1] * wide[2])
    cuts = cuts.withColumn("score", F.expr("top div base"))
    # k, l and r of the lowest score, the smallest k of equal ones
    best = F.min(F.struct("score", "k", "l", "r"))
    return (cuts.groupBy("lang", "phrase", "words", F.col("c").alias("a")).agg(best.alias("best"))
            .select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score"))


def uncovered(candidates: DataFrame, counts: DataFrame, covered: int) -> DataFrame:
    """The candidates that no longer candidate accounts for; ``counts``: all candidates."""
    inner = F.expr("""flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1),
        i -> array_join(slice(split(phrase, ' '), i, n), ' '))))""")
    longer = (counts.where("words > 2").select("lang", "c", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("c").alias("most")))
    return candidates.join(longer, ["lang", "phrase"], "left").where(f"most is null or 100 * most < {covered} * a").drop("most")


def mine(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_words: int = 3, least: int = 10, top: int = 2000,
         covered: int = 50, filter_bits: int = 1 << 26, hold: int = 2_000_000, part_bytes: int = 4 << 20, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, first_doc, first_byte: the ``top`` phrases of 2 to ``max_words`` words of every lang.

    ``filter_bits``: a power of two, at least 2**15; ``part_bytes``: text whose fingerprints are counted together;
    ``bits``: of a fingerprint (fewer only make collisions).
    """
    d = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = d.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(64, -(-size // part_bytes))
    table = bit_table(frequent_bits(d, max_words, least, bits, hold, parts, filter_bits), filter_bits)
    counts = saved(phrase_counts(d, table, max_words, bits, parts, least, hold // 2))
    totals = saved(counts.where("words = 0").select("lang", F.col("c").alias("n")))
    out = uncovered(scored(counts), counts, covered)
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    out = saved(out.withColumn("rank", F.row_number().over(first).cast("long")).where(F.col("rank") <= top))
    out = counts.select("lang", "phrase", "doc", "at").join(small(out, 100_000), ["lang", "phrase"])
    return out.join(small(totals, 10_000), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("doc").alias("first_doc"), F.col("at").alias("first_byte"))
