"""Toxic spans and document scores by a linear-chain conditional random field.

1. Sample.  At most ``max_labelled`` labelled documents of the training folds of each kind, those of least hash of
   doc_id, fit the scores of documents; of these, at most ``max_toxic`` and ``max_clean`` of at most ``max_bytes``
   bytes of text each fit the field on the driver.  They are chosen on (doc_id, length) alone, so texts
   are not shuffled.
2. Labelled tokens.  Labels are of documents, so tokens of clean documents are clean, and tokens of toxic
   documents are toxic if a feature of theirs (the word or a beginning of it) is far more frequent in
   toxic documents than chance allows.  After a first fit, tokens that the model itself finds toxic in toxic
   documents join them, and the fit goes on.
3. The field.  Two tags; hashed features of each word (itself, beginnings, endings, capital) and transitions inside a
   sentence; maximum likelihood with a square penalty by Adam steps over the whole sample.
4. Marginals.  Forward and backward messages of all sentences of a batch run together, a word at a time;
   with two tags a message is one log-odds.  Neighbouring words of marginal over 0.5 are a span.
5. Documents.  A logistic regression turns the marginals of a document (their sum, the greatest, the number over
   0.5, and the number of words) into its score.  It is fitted on labelled documents of any length, with marginals from
   a field that was trained on the other half of the sample; executors compute these, a few numbers a document,
   and they are weighted back to the numbers of all labelled documents.

Only the text is an input of a score.  Every document is scored whole, in the task that reads it; the model
is a closure of a few MB.  Offsets are bytes of the UTF-8 text.

Defined cases: null is the empty text; documents without words get the score of no evidence; a doc_id with
several labels is toxic if one says so; null doc_ids are of the fold of the empty text; repeated rows
are scored each; without labels of both kinds every score is the smoothed share of toxic labels; an empty
table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscalflow.llm._common import batches, saved, small
from fiscalflow.llm._words import NOT_WORD, U, Words, chunks, kinds, scrambled, spans_hashed, split

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLE = kinds(NOT_WORD, [*b".!?\n"])
BITS = 20
BEGINNINGS, ENDINGS = (4, 5, 6, 7, 8, 9, 10), (3, 4, 5)
SEEDS = 1 + len(BEGINNINGS)  # features that may mark a token: the word and its beginnings


def features(w: Words) -> np.ndarray:
    """(features, words) bucket numbers; 0 where a word has no such feature."""
    sums, size = w.sums(), w.end - w.start
    spans = [(w.start, w.end, size > 0)]
    spans += [(w.start, np.minimum(w.start + n, w.end), size > n) for n in BEGINNINGS]
    spans += [(np.maximum(w.end - n, w.start), w.end, size > n) for n in ENDINGS]
    out = [np.where(on, (scrambled(spans_hashed(sums, a, b) + U(i + 1)) >> U(64 - BITS)).astype(np.int32) | 2, 0) for i, (a, b, on) in enumerate(spans)]
    return np.stack([*out, w.upper.astype(np.int32)])


def sentences(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, number of words) of each sentence, the longest first."""
    first = np.flatnonzero(np.concatenate(([True], w.piece[1:] != w.piece[:-1])))[:len(w)]
    size = np.diff(np.concatenate((first, [len(w)])))
    order = np.argsort(-size, kind="stable")
    return first[order], size[order]


@dataclass
class Field:
    weights: np.ndarray  # of each bucket, for the tag toxic
    moves: np.ndarray  # (2, 2): log weight of a tag after a tag
    start: float  # log-odds of toxic at the start of a sentence

    def evidence(self, f: np.ndarray) -> np.ndarray:
        out = np.zeros(f.shape[1])
        for row in f:
            out += self.weights[row]
        return out

    def messages(self, e: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds that reach each word from the left (with its own evidence) and from the right."""
        left, right = np.zeros(len(e)), np.zeros(len(e))
        (m00, m01), (m10, m11) = self.moves
        left[first] = self.start + e[first]
        longest = int(size.max(initial=0))
        active = np.searchsorted(-size, -np.arange(longest + 1), "left")  # sentences of more than t words
        for t in range(1, longest):
            at = first[:active[t]] + t
            r = left[at - 1]
            left[at] = e[at] + np.logaddexp(m01, m11 + r) - np.logaddexp(m00, m10 + r)
        for t in range(longest - 2, -1, -1):
            at = first[:active[t + 1]] + t
            q = e[at + 1] + right[at + 1]
            right[at] = np.logaddexp(m10, m11 + q) - np.logaddexp(m00, m01 + q)
        return left, right

    def log_odds(self, f: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Of the marginal of each word."""
        left, right = self.messages(self.evidence(f), first, size)
        return left + right


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def gradient(field: Field, f: np.ndarray, first: np.ndarray, size: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of the log likelihood: by word evidence, moves and start."""
    e = field.evidence(f)
    left, right = field.messages(e, first, size)
    p = sigmoid(left + right)
    inner = np.ones(len(e), bool)
    inner[first] = False
    b = np.flatnonzero(inner)
    q = e[b] + right[b]
    joint = np.stack([np.zeros(len(b)) + field.moves[0, 0], field.moves[0, 1] + q, left[b - 1] + field.moves[1, 0], left[b - 1] + field.moves[1, 1] + q])
    joint = np.exp(joint - joint.max(axis=0))
    joint /= joint.sum(axis=0)
    seen = np.bincount(2 * tags[b - 1] + tags[b], minlength=4)
    return tags - p, (seen - joint.sum(axis=1)).reshape(2, 2), float((tags[first] - p[first]).sum())


def fit(field: Field, f: np.ndarray, first: np.ndarray, size: np.ndarray, tags: np.ndarray, steps: int, penalty: float = 0.02, rate: float = 0.25) -> None:
    """Adam steps over all sentences, in place."""
    seen = np.zeros(len(field.weights), bool)
    for row in f:
        seen[row] = True
    used = np.flatnonzero(seen)
    place = np.zeros(len(seen), np.int32)
    place[used] = np.arange(len(used))
    compact = place[f]
    x = np.concatenate([field.weights[used], field.moves.ravel(), [field.start]])
    m, v = np.zeros(len(x)), np.zeros(len(x))
    for t in range(1, steps + 1):
        now = Field(x[:len(used)], x[len(used):-1].reshape(2, 2), x[-1])
        by_word, moves, start = gradient(now, compact, first, size, tags)
        g = np.zeros(len(used))
        for row in compact:
            g += np.bincount(row, by_word, len(used))
        g = np.concatenate([g - penalty * now.weights, moves.ravel(), [start]])
        if used[0] == 0:
            g[0] = 0  # the bucket of absent features
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x + rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-3)
    field.weights[used] = x[:len(used)]
    field.moves, field.start = x[len(used):-1].reshape(2, 2), float(x[-1])


def seeds(f: np.ndarray, doc: np.ndarray, toxic: np.ndarray, mine: np.ndarray, least_z: float = 5, ratio: float = 4) -> np.ndarray:
    """Whether each word of a toxic document has a feature of toxic documents; counts by documents of ``mine``."""
    n_toxic, n_clean = int((mine & toxic).sum()), int((mine & ~toxic).sum())
    share = n_toxic / max(1, n_toxic + n_clean)
    out = np.zeros(f.shape[1], bool)
    on = mine[doc]
    for row in f[:SEEDS]:
        pair = np.unique(doc[on].astype(np.int64) << BITS | row[on])
        of, bucket = pair >> BITS, pair & ((1 << BITS) - 1)
        a, b = (np.bincount(bucket[toxic[of] == x], minlength=1 << BITS) for x in (True, False))
        expected = (a + b) * share
        z = (a - expected) / np.sqrt(np.maximum(expected * (1 - share), 1e-9))
        strong = (z >= least_z) & (a * max(1, n_clean) >= ratio * (b + 0.5) * n_toxic)
        strong[0] = False
        out |= strong[row]
    return out & toxic[doc]


def trained(w: Words, f: np.ndarray, toxic: np.ndarray, mine: np.ndarray, steps: tuple[int, int]) -> Field:
    """The field of the documents ``mine``."""
    field = Field(np.zeros(1 << BITS), np.zeros((2, 2)), -3.0)
    keep = np.flatnonzero(mine[w.doc])
    sub = Words(w.data, w.start[keep], w.end[keep], w.doc[keep], w.piece[keep], w.at[keep], w.upper[keep])
    f = f[:, keep]
    first, size = sentences(sub)
    tags = seeds(f, sub.doc, toxic, mine).astype(np.int64)
    if not tags.any():
        return field
    fit(field, f, first, size, tags, steps[0])
    more = (field.log_odds(f, first, size) > 0) & toxic[sub.doc]
    fit(field, f, first, size, np.maximum(tags, more), steps[1])
    return field


def document_inputs(odds: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """(n, 5) inputs of the regression from the log-odds of all words."""
    p = sigmoid(odds)
    most = np.full(n, -8.0)
    np.maximum.at(most, doc, np.clip(odds, -8, 8))
    return np.stack([np.ones(n), np.log1p(np.bincount(doc, p, n)), most / 4, np.log1p(np.bincount(doc, p > 0.5, n)), np.log1p(np.bincount(doc, minlength=n)) / 4], axis=1)


def regression(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ beta)
        g = x.T @ (weight * (y - p)) - penalty * beta
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(beta))
        step = np.linalg.solve(h, g)
        beta += step * min(1, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass
class Model:
    field: Field
    beta: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(x @ self.beta)


def without_evidence(share: float) -> Model:
    """Every document has the same score."""
    return Model(Field(np.zeros(1 << BITS, np.float32), np.zeros((2, 2)), -3.0), np.array([np.log(share / (1 - share)), 0, 0, 0, 0]))


def train_fields(texts: list[str], toxic: np.ndarray, half: np.ndarray, steps: tuple[int, int] = (15, 8)) -> list[Field]:
    """The fields of the documents of half 0, of half 1, and of all."""
    w = split(pa.array(texts, pa.string()), TABLE)
    f = features(w)
    out = [trained(w, f, toxic, mine, steps) for mine in (half == 0, half == 1, np.ones(len(texts), bool))]
    for field in out:
        field.weights = field.weights.astype(np.float32)   # half the closure
    return out


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def labelled(docs: DataFrame, labels: DataFrame, folds: int, most: int) -> tuple[DataFrame, tuple[int, int]]:
    """(doc, toxic, size, half) of at most ``most`` labelled training documents of each kind, and how many there are of both."""
    known = labels.where("toxic is not null").groupBy("doc").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc"), folds))
    sized = docs.groupBy("doc").agg(F.max(F.octet_length("text")).alias("size"))
    mine = saved(known.join(sized, "doc").select("doc", (F.col("toxic") > 0).alias("toxic"), "size"))
    totals = {r["toxic"]: r["c"] for r in mine.groupBy("toxic").agg(F.count(F.lit(1)).alias("c")).collect()}
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc"), "doc")
    first = mine.withColumn("n", F.row_number().over(order)).where(F.col("n") <= most)
    return saved(first.withColumn("half", (F.col("n") % 2).cast("int"))), (totals.get(True, 0), totals.get(False, 0))


def train(docs: DataFrame, ids: DataFrame, totals: tuple[int, int], max_toxic: int, max_clean: int, max_bytes: int) -> Model:
    """The model of the labelled documents ``ids``."""
    if not all(totals):
        return without_evidence((totals[0] + 0.5) / (sum(totals) + 2))
    order = Window.partitionBy("toxic").orderBy("n")
    some = (ids.where(F.col("size") <= max_bytes).withColumn("m", F.row_number().over(order))
            .where(F.col("m") <= F.when(F.col("toxic"), max_toxic).otherwise(max_clean)).select("doc", "toxic", "half"))
    rows = (docs.join(small(saved(some), 100_000), "doc").where(F.octet_length("text") <= max_bytes).orderBy(F.xxhash64("doc"), "doc", "text")
            .limit(2 * (max_toxic + max_clean)).select("text", "toxic", "half").collect())
    if len({r["toxic"] for r in rows}) < 2:
        return without_evidence((totals[0] + 0.5) / (sum(totals) + 2))
    fields = train_fields([r["text"] for r in rows], np.array([r["toxic"] for r in rows], bool), np.array([r["half"] for r in rows]))
    # a row for each labelled document, of repeated ids one
    seen = calibration(docs.join(small(ids.select("doc", "toxic", "half"), 100_000), "doc"), fields[:2])
    got = seen.groupBy("doc", "toxic").agg(F.min("x").alias("x")).orderBy(F.xxhash64("doc"), "doc").collect()
    x, y = np.array([r["x"] for r in got]), np.array([r["toxic"] for r in got], bool)
    weight = np.where(y, totals[0] / y.sum(), totals[1] / (~y).sum())
    return Model(fields[2], regression(x, y.astype(float), weight / weight.mean()))


def calibration(docs: DataFrame, fields: list[Field]) -> DataFrame:
    """(doc, toxic, x): inputs of the regression from the field of the other half; ``docs``: doc, text, toxic, half."""
    kind = docs.schema["doc"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it):
            w = split(b.column("text"), TABLE)
            half = b.column("half").to_numpy()
            x = np.zeros((len(b), 5))
            f, where = features(w), sentences(w)
            for other, field in enumerate(fields):
                odds = field.log_odds(f, *where) if len(w) else np.zeros(0)
                x[half != other] = document_inputs(odds, w.doc, len(b))[half != other]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, 5 * len(b) + 1, 5, dtype=np.int32)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("toxic"), lists], names=["doc", "toxic", "x"])

    return batches(docs.select("doc", "toxic", "half", "text"), run, f"doc {kind}, toxic boolean, x array<double>")


SPAN = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def spans_of(w: Words, odds: np.ndarray, n: int) -> pa.Array:
    """Spans of neighbouring toxic words in each document."""
    hot = odds > 0
    same = np.concatenate(([False], w.piece[1:] == w.piece[:-1]))[:len(hot)]
    opens = np.flatnonzero(hot & ~(same & np.concatenate(([False], hot[:-1]))[:len(hot)]))
    closes = np.flatnonzero(hot & ~(np.concatenate((same[1:], [False]))[:len(hot)] & np.concatenate((hot[1:], [False]))[:len(hot)]))
    total = np.concatenate(([0], np.cumsum(sigmoid(odds))))
    score = (total[closes + 1] - total[opens]) / (closes + 1 - opens)
    offsets = np.searchsorted(w.doc[opens], np.arange(n + 1))
    values = pa.StructArray.from_arrays([pa.array(w.at[opens]), pa.array(w.at[closes] + (w.end - w.start)[closes]), pa.array(score)], fields=list(SPAN))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc, held_out, score, spans of every document; ``docs``: doc, held_out, text."""
    kind = docs.schema["doc"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it):
            w = split(b.column("text"), TABLE)
            odds = model.field.log_odds(features(w), *sentences(w)) if len(w) else np.zeros(0)
            score = model.score(document_inputs(odds, w.doc, len(b)))
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("held_out"), pa.array(score), spans_of(w, odds, len(b))], names=["doc", "held_out", "score", "spans"])

    return batches(docs, run, f"doc {kind}, held_out boolean, score double, spans array<struct<first:bigint,end:bigint,score:double>>")


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 5,
          max_toxic: int = 500, max_clean: int = 700, max_bytes: int = 10_000, max_labelled: int = 5_000) -> DataFrame:
    """doc_id, held_out, score, predicted, spans (first and end byte, mean marginal) of every document.

    ``max_toxic``, ``max_clean``, ``max_bytes``: bounds of the labelled sample that the field is fitted on;
    ``max_labelled``: labelled documents of each kind, of any length, that the scores are fitted on.
    """
    d = docs.select(F.col(doc_id).alias("doc"), held_out(F.col(doc_id), folds).alias("held_out"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    marked = labels.select(F.col(doc_id).alias("doc"), F.col(label).cast("int").alias("toxic")).where("doc is not null")
    learned = d.where("not held_out").select("doc", "text")
    ids, totals = labelled(learned, marked, folds, max_labelled)
    model = train(learned, ids, totals, max_toxic, max_clean, max_bytes)
    return score_texts(d, model).select(F.col("doc").alias(doc_id), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
