"""Benchmark decontamination by a prefix-filtered set join (native columns only).

A *window* is ``size`` consecutive words of a benchmark item (all its words if it has
fewer).  Finding a window in a document is a containment join at overlap 1: every
word of the window has to occur, so of its words ordered by rarity a prefix of one, the
rarest, is enough to find all candidates.  Rarity is the number of times a word occurs in
all items, longer words first among equals.  Documents' words are joined with the windows' rarest
words only; each meeting fixes where the window would start, and the positional and length
bounds (start >= 0, start + length <= words of the document) drop it or keep it as a candidate.  Candidates are then compared word for word with the document.

Candidates are keyed by a hash of the document's text, so copies share them; the comparison
with the real text makes a hash collision harmless.  Word counts and candidates are
partial aggregates; the only text shuffle is the join of documents with candidates, whose
other side has one row a text, so that skewed copies can be split.

Defined cases: a null or wordless text has no words and is clean; null ids stay null;
repeated documents each get their row; repeated items with the same id count once;
wordless or null items have no windows; empty tables on either side work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm._common import saved, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# what stands between words, once A-Z are lower-case
# columns that decontaminate adds for itself
STEPS = ("__key", "__cand", "__near", "__hits", "__spans", "__n", "__hit")
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of the text with A-Z lower-cased; an empty array for null."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(t, GAP), "")


def folded(text: Column) -> Column:
    """All letters lower-cased, each without regard to its neighbours: of all letters only the capital
    sigma has a small form that depends on them, so it gets one form first."""
    return F.lower(F.replace(text, F.lit("\u03a3"), F.lit("\u03c3")))


def folded_words_of(text: Column) -> Column:
    """As many words as ``words_of``, with all letters lower-cased, which costs far less.

    Texts whose words agree also agree here, so this is enough to find candidates.
    """
    return F.array_remove(F.split(folded(F.coalesce(text, F.lit(""))), GAP), "")


def windows_of(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(window: array of words, items: ids) for the distinct windows of all items."""
    w = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - size))
    w = w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, F.lit(size)))).alias("window"))
    return w.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def rarest_words(windows: DataFrame, items_words: DataFrame, rows: int) -> DataFrame:
    """windows plus rare (the word) and at (its first place in the window).

    ``items_words``: word; a row for each word of each item.
    """
    times = saved(items_words.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    placed = windows.select("id", F.posexplode("folded").alias("at", "word"))
    ranked = placed.join(small(times, rows), "word").groupBy("id").agg(
        F.min(F.struct("n", (-F.octet_length("word")).alias("short"), "word", "at")).alias("r"))
    return windows.join(ranked, "id").select("id", "window", "items", "folded", F.col("r.word").alias("rare"), F.col("r.at").alias("at"))


def union_length(spans: Column) -> Column:
    """Number of places covered by sorted (first, end) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(a: Column, s: Column) -> Column:
        return F.struct(F.greatest(a["end"], s["end"]).alias("end"),
                        (a["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(a["end"], s["first"]))).alias("n"))

    return F.aggregate(spans, zero, step, lambda a: a["n"])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  size: int = 13, share: int = 20, broadcast_rows: int = 200_000,
                  out: str = "__contamination") -> DataFrame:
    """``docs`` plus a struct ``out``: n_words, n_hit, items (sorted ids), spans, contaminated.

    A column named ``out`` is replaced.  A document is contaminated if it has a hit word and ``share * n_hit >= n_words``.
    ``broadcast_rows`` bounds the windows that are broadcast; more are joined by shuffle.
    """
    # columns of docs that are named like a step get another name until the end
    others = {c: f"{c} of docs" for c in STEPS if c in docs.columns and c != out}
    d = docs.withColumnsRenamed(others)
    text = others.get(text, text)
    d = d.withColumn("__key", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    windows = windows_of(items, item_id, item_text, size).withColumn("folded", F.transform("window", folded))
    windows = saved(windows.withColumn("id", F.monotonically_increasing_id()))
    spoken = items.select(F.explode(folded_words_of(F.col(item_text))).alias("word"))
    rare = saved(rarest_words(windows, spoken, broadcast_rows))
    probe = small(rare.select(F.col("rare").alias("word"), "id", "at", F.size("window").alias("len")), broadcast_rows)
    # the number of words is a column of its own, or each word would carry the whole array
    met = (d.select("__key", folded_words_of(F.col(text)).alias("w")).select("__key", "w", F.size("w").alias("n"))
           .select("__key", "n", F.posexplode("w").alias("pos", "word")).join(probe, "word")
           .withColumn("start", F.col("pos") - F.col("at")).where("start >= 0 and start + len <= n"))
    found = met.groupBy("__key").agg(F.collect_set(F.struct("start", "id")).alias("c"))
    text_of = small(rare.select("id", "window", "folded", "items"), broadcast_rows)
    listed = saved(found.select("__key", F.inline("c")).join(text_of, "id").groupBy("__key").agg(
        F.array_sort(F.collect_list(F.struct("start", "window", "folded", "items"))).alias("__cand")))
    joined = d.join(listed, "__key", "left")

    def same(w: Column, part: str):
        return lambda c: F.slice(w, c["start"] + 1, F.size(c["window"])) == c[part]

    # the words are the argument of an outer lambda: computed once a document, not once a candidate
    near = F.transform(F.array(folded_words_of(F.col(text))), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.filter(F.col("__cand"), same(w, "folded")).alias("c")))[0]
    joined = joined.withColumn("__near", near).withColumn("__n", F.col("__near.n"))
    real = F.transform(F.array(words_of(F.col(text))), lambda w: F.filter(F.col("__near.c"), same(w, "window")))[0]
    joined = joined.withColumn("__hits", F.when(F.size("__near.c") > 0, real))
    spans = F.array_sort(F.array_distinct(F.transform("__hits", lambda c: F.struct(
        c["start"].cast("long").alias("first"), (c["start"] + F.size(c["window"])).cast("long").alias("end")))))
    spans = F.coalesce(spans, F.array().cast("array<struct<first:bigint,end:bigint>>"))
    items_hit = F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.transform("__hits", lambda c: c["items"])))),
                           F.array().cast("array<string>"))
    joined = joined.withColumn("__spans", spans)
    n_hit = union_length(F.col("__spans"))
    joined = joined.withColumn("__hit", n_hit)
    return joined.withColumn(out, F.struct(
        F.col("__n").alias("n_words"), F.col("__hit").alias("n_hit"), items_hit.alias("items"), F.col("__spans").alias("spans"),
        ((F.col("__hit") > 0) & (F.lit(share) * F.col("__hit") >= F.col("__n"))).alias("contaminated"),
    )).drop(*STEPS).withColumnsRenamed({v: k for k, v in others.items()})
