"""Quality rules by distribution divergence.

A document is compared with the reference of its language by two histograms: the share of
its bytes in each character class, and the share of its words that are each of the
language's common words (and none of them).  The measure is the Jensen-Shannon distance
(base 2, 0 to 1).  A reference is the mean of the histograms of all documents of the
language, one vote a document, worked out as a distributed sum.  Short documents say little,
so each comparison has a least length below which it isn't made.

Both passes are Arrow batches: the first sums histograms (a row per language and task),
the second gives each document its verdict.  Every value of the language column has a character
reference of its own; these are rows that are joined to the documents (broadcast only if they
are few).  Only the references of the languages with a word list go through the driver.

Defined cases: null text counts as empty and fails the base rule; a null language, or one
without a document that has a vote, has no reference and skips the character comparison, a
language without a word list skips the word comparison; an
empty table gives no references and no rows; repeated rows get equal verdicts; columns named
like a result are kept, as the results are fields of one struct.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalflow.llm._common import TEXTS, batches, saved, small

# fixed values: common words of each language, the bins of the word histogram
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he this are or his from at which but have an they you".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se le ce il sont la ou avec".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si".split(),
    "it": "di e il la che in a per un è del non sono della con si da i le una come al dei nel ha più lo alla o gli".split(),
    "pt": "de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu sua ou".split(),
    "nl": "de van het een en in is dat op te zijn met voor niet aan er om ook als dan maar bij of uit nog worden door naar hij tot".split(),
}
COMMON_WORDS = {k: list(dict.fromkeys(v)) for k, v in COMMON_WORDS.items()}

CLASSES = ("lower", "upper", "digit", "space", "stop", "mark", "symbol", "control", "letter", "rest")


def _class_of(b: int) -> int:
    c = chr(b)
    if b >= 0xC0:
        return CLASSES.index("letter")  # the first byte of a character beyond ASCII
    if b >= 0x80:
        return CLASSES.index("rest")  # its other bytes: left out of the histogram
    if "a" <= c <= "z":
        return CLASSES.index("lower")
    if "A" <= c <= "Z":
        return CLASSES.index("upper")
    if c.isdigit():
        return CLASSES.index("digit")
    if c in " \t\n\v\f\r":
        return CLASSES.index("space")
    if c in ".,;:'\"-!?()":
        return CLASSES.index("stop")
    if b < 32 or b == 127:
        return CLASSES.index("control")
    return CLASSES.index("symbol") if c in "#*$%&|<>" else CLASSES.index("mark")


CLASS = np.array([_class_of(b) for b in range(256)])
N_CHARS = len(CLASSES) - 1
STRIP = re.compile(rb"[\x00-\x1f!-/:-@\[-`{-\x7f]+")
N_BINS = max(map(len, COMMON_WORDS.values())) + 1
WORD_BIN = {k: {w.encode(): i for i, w in enumerate(v)} for k, v in COMMON_WORDS.items()}
SPACES = [9, 10, 11, 12, 13, 32]
SYMBOLS = [ord(c) for c in "#*$%&|<>"]


def histograms(data: bytes, lang: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Counts of the 256 byte values, of the character classes, and of the common words."""
    raw = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    chars = np.bincount(CLASS, weights=raw, minlength=len(CLASSES))[:N_CHARS]
    bins = WORD_BIN.get(lang)
    if bins is None:
        return raw, chars, None
    seen = Counter(data.lower().translate(None, b".,;:!?\"()").split())
    words = np.zeros(N_BINS)
    for w, i in bins.items():
        words[i] = seen.get(w, 0)
    words[-1] = seen.total() - words.sum()
    return raw, chars, words


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, each scaled to sum 1; base 2."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def kl(a: np.ndarray) -> float:
        k = a > 0
        return float((a[k] * np.log2(a[k] / m[k])).sum())

    return float(np.sqrt(max(0.0, (kl(p) + kl(q)) / 2)))


def base_rules(data: bytes, raw: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = data.split()
    n = len(words)
    lines = [x for x in data.split(b"\n") if x.strip()] if b"\n" in data else []
    grams = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(grams)) < len(grams):
        times = Counter(grams)
        end = 0  # first word not counted yet
        for i, g in enumerate(grams):
            if times[g] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    points = int(raw.sum() - raw[0x80:0xC0].sum())
    return n, points - int(raw[SPACES].sum()), int(raw[SYMBOLS].sum()), len(lines) - len(set(lines)), repeated


PARTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("kind", T.StringType()),
                      T.StructField("bin", T.IntegerType()), T.StructField("total", T.DoubleType()),
                      T.StructField("docs", T.LongType())])


# languages whose sums a task holds at once
HELD = 10_000


def reference_rows(docs: DataFrame, text: str = "text", lang: str = "lang", min_words: int = 50) -> DataFrame:
    """(lang, kind: "chars" or "words", bins): the mean histogram of each value of ``lang``.

    Documents of fewer than ``min_words`` words, or without a language, have no vote.
    """
    def rows_of(sums: dict[tuple[str, str], np.ndarray]) -> pa.RecordBatch:
        rows = [(k, kind, i, float(x), int(s[-1])) for (k, kind), s in sums.items() for i, x in enumerate(s[:-1])]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.string(), pa.string(), pa.int32(), pa.float64(), pa.int64()))], names=PARTS.names)

    def parts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], np.ndarray] = {}
        for b in it:
            for t, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = (t or "").encode()
                _, chars, words = histograms(data, name)
                n_words = words.sum() if words is not None else len(data.split())
                if n_words < min_words:
                    continue
                for kind, h in (("chars", chars), ("words", words)):
                    if h is not None and h.any():
                        s = sums.setdefault((name, kind), np.zeros(len(h) + 1))
                        s[:-1] += h / h.sum()
                        s[-1] += 1
            if len(sums) > HELD:
                yield rows_of(sums)
                sums.clear()
        yield rows_of(sums)

    name = F.col(lang) if lang in docs.columns else F.lit(None).cast("string")
    named = docs.select(F.col(text).cast("string"), name.cast("string").alias("__lang")).where("__lang is not null")
    got = batches(named, parts, PARTS, TEXTS)
    mean = got.groupBy("lang", "kind", "bin").agg(F.round(F.sum("total") / F.sum("docs"), 9).alias("x"))
    listed = mean.groupBy("lang", "kind").agg(F.sort_array(F.collect_list(F.struct("bin", "x"))).alias("b"))
    return listed.select("lang", "kind", F.col("b.x").alias("bins"))


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang", min_words: int = 50) -> dict:
    """{(language, "chars" or "words"): mean histogram} of the languages with a word list."""
    return listed_references(reference_rows(docs, text, lang, min_words))


def listed_references(references: DataFrame) -> dict:
    rows = references.where(F.col("lang").isin(*COMMON_WORDS)).collect()  # languages with a list x 2
    return {(r["lang"], r["kind"]): np.array(r["bins"]) for r in rows}


OUT = "__quality"
VERDICT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()), T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()), T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()), T.StructField("char_distance", T.DoubleType()),
    T.StructField("word_distance", T.DoubleType()), T.StructField("kept", T.BooleanType())])


def judge(docs: DataFrame, references: DataFrame, text: str = "text", lang: str = "lang", char_limit: float = 0.30,
          word_limit: float = 0.32, min_char_words: int = 50, min_hist_words: int = 100, out: str = OUT, broadcast_rows: int = 100_000) -> DataFrame:
    """``docs`` plus a struct ``out`` (VERDICT); a column of that name is replaced.

    ``references``: saved ``reference_rows``; more than ``broadcast_rows`` are joined by shuffle.

    Base rules: at least 50 words, and at most half of the words in repeated 3-word windows.
    A distance that isn't measured (too short, no reference) is null and rejects nothing.
    """
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, VERDICT)])
    names = schema.names
    at, at_lang = docs.columns.index(text), docs.columns.index(lang) if lang in docs.columns else None
    words_of = {k: x for (k, kind), x in listed_references(references).items() if kind == "words"}
    chars_of = small(references.where("kind = 'chars'").select(F.col("lang").alias("__name"), F.col("bins").alias("__bins")), broadcast_rows)
    if at_lang is None:
        d = docs.withColumn("__bins", F.lit(None).cast("array<double>"))
    else:
        d = docs.join(chars_of, docs[lang].cast("string") == chars_of["__name"], "left").drop("__name")

    def verdict(t: str | None, name: str | None, mean: list[float] | None) -> tuple:
        data = (t or "").encode()
        raw, chars, words = histograms(data, name)
        base = base_rules(data, raw)
        n, repeated = base[0], base[4]
        failed = n < 50 or 100 * repeated > 50 * n
        dc = dw = None
        if n >= min_char_words and mean is not None:
            dc = js_distance(chars, np.array(mean))
        if n >= min_hist_words and words is not None and words.sum() > 0 and name in words_of:
            dw = js_distance(words, words_of[name])
        kept = not failed and not (dc is not None and dc > char_limit) and not (dw is not None and dw > word_limit)
        return *base, failed, dc, dw, kept

    kind = pa.struct([(f.name, {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[f.dataType.simpleString()])
                      for f in VERDICT.fields])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            langs = b.column(at_lang).cast(pa.string()).to_pylist() if at_lang is not None else [None] * len(b)
            rows = [verdict(*x) for x in zip(b.column(at).to_pylist(), langs, b.column(len(names) - 1).to_pylist())]
            cols = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kind)]
            q = pa.StructArray.from_arrays(cols, fields=list(kind))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], q], names=names)

    return batches(d, run, schema, TEXTS)


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", **limits) -> DataFrame:
    """``docs`` plus a struct ``__quality``, with references drawn from all of ``docs``."""
    return judge(docs, saved(reference_rows(docs, text, lang)), text, lang, **limits)
