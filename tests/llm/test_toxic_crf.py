"""The random field against enumeration of all taggings; scores and spans on held-out documents."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fiscalflow.llm import toxic_crf as op
from tests.llm.tables import documents


def field(rng):
    return op.Field(rng.normal(size=20), rng.normal(size=(2, 2)), float(rng.normal()))


def weight(f, e, tags):
    out = f.start * tags[0] + sum(x * t for x, t in zip(e, tags))
    return out + sum(f.moves[a, b] for a, b in zip(tags, tags[1:]))


def log_z(f, e):
    return np.logaddexp.reduce([weight(f, e, t) for t in itertools.product((0, 1), repeat=len(e))])


SIZES = [5, 3, 3, 1, 1]
FIRST = np.array([4, 9, 1, 0, 12])  # sentences as they lie: 1, 3, 5, 3, 1 words


def test_marginals_are_those_of_all_taggings():
    rng = np.random.default_rng(3)
    fld, f = field(rng), rng.integers(1, 20, (3, 13)).astype(np.int32)
    got = op.sigmoid(fld.log_odds(f, FIRST, np.array(SIZES)))
    e = fld.evidence(f)
    for a, n in zip(FIRST, SIZES):
        taggings = list(itertools.product((0, 1), repeat=n))
        p = np.exp(np.array([weight(fld, e[a:a + n], t) for t in taggings]) - log_z(fld, e[a:a + n]))
        assert np.allclose(got[a:a + n], p @ np.array(taggings))


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(4)
    fld, f, tags = field(rng), rng.integers(1, 20, (2, 13)).astype(np.int32), rng.integers(0, 2, 13)

    def likelihood(x):
        e = x.evidence(f)
        return sum(weight(x, e[a:a + n], tags[a:a + n]) - log_z(x, e[a:a + n]) for a, n in zip(FIRST, SIZES))

    by_word, moves, start = op.gradient(fld, f, FIRST, np.array(SIZES), tags)
    h = 1e-5
    for i in range(1, 20):
        up, down = (op.Field(fld.weights + s * h * (np.arange(20) == i), fld.moves, fld.start) for s in (1, -1))
        assert np.isclose((likelihood(up) - likelihood(down)) / (2 * h), sum(by_word[row == i].sum() for row in f), atol=1e-4)
    for i, j in itertools.product((0, 1), (0, 1)):
        d = np.zeros((2, 2))
        d[i, j] = h
        assert np.isclose((likelihood(op.Field(fld.weights, fld.moves + d, fld.start)) - likelihood(op.Field(fld.weights, fld.moves - d, fld.start))) / (2 * h), moves[i, j], atol=1e-4)
    assert np.isclose((likelihood(op.Field(fld.weights, fld.moves, fld.start + h)) - likelihood(op.Field(fld.weights, fld.moves, fld.start - h))) / (2 * h), start, atol=1e-4)


def test_likelihood_rises():
    rng = np.random.default_rng(5)
    f = rng.integers(2, 1000, (2, 400)).astype(np.int32)
    tags = (f[0] < 200).astype(np.int64)
    first, size = np.arange(0, 400, 10), np.full(40, 10)
    fld = op.Field(np.zeros(1 << op.BITS), np.zeros((2, 2)), -3.0)
    op.fit(fld, f, first, size, tags, 40)
    assert ((fld.log_odds(f, first, size) > 0) == tags.astype(bool)).mean() > 0.95


def folded(i, folds=5):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds == 0


def corpus(n=500):
    rng = random.Random(9)
    calm = [f"{a}{b}" for a in ("lor", "ip", "dol", "am", "cons") for b in ("em", "sum", "et", "or", "ectus", "is")]
    bad = ["grumpfel", "snorkwit", "blargface"]
    docs = []
    for i in range(n):
        w = [rng.choice(calm) for _ in range(rng.randrange(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(bad)
        docs.append((i, "".join(x + rng.choice([" ", " ", " ", ". ", "\n"]) for x in w), int(toxic)))
    return docs, bad


def test_held_out_documents_and_spans(spark):
    docs, bad = corpus()
    d = spark.createDataFrame([x[:2] for x in docs], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, t) for i, _, t in docs if i % 10 != 3], "doc_id long, toxic int")
    out = {r.doc_id: r for r in op.score(d, labels).collect()}
    assert len(out) == len(docs)
    for i, text, toxic in docs:
        assert out[i].held_out == folded(i) and out[i].predicted == toxic == (out[i].score >= 0.5)
        found = [text.encode()[s["first"]:s["end"]].decode() for s in out[i].spans]
        assert (sorted(w for x in found for w in x.split()) == sorted(w for w in text.replace(".", " ").split() if w in bad))


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, _ = corpus(200)
    d = spark.createDataFrame([x[:2] for x in docs], "doc_id long, text string").coalesce(1)
    both = [spark.createDataFrame([(i, t if not folded(i) else flip(t)) for i, _, t in docs], "doc_id long, toxic int") for flip in (lambda t: t, lambda t: 1 - t)]
    a, b = ([(r.doc_id, r.score) for r in op.score(d, x).orderBy("doc_id").collect()] for x in both)
    assert a == b


def test_given_documents(spark):
    """Held-out labelled documents of the given table: none of the clean ones, most of the toxic ones."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = op.score(documents(spark, "sf0.01"), labels).where("held_out").join(labels, "doc_id").collect()
    clean = [r.predicted for r in got if not r.toxic]
    toxic = [r.score for r in got if r.toxic]
    assert sum(clean) <= 0.03 * len(clean)
    assert np.mean([s > np.median([r.score for r in got if not r.toxic]) for s in toxic]) > 0.75


@pytest.mark.parametrize("marks", [[], [(0, 0), (1, 0)], [(0, 1), (2, 0), (2, 1), (None, 1), (4, None)]])
def test_odd_rows(spark, odd_documents, no_documents, marks):
    labels = spark.createDataFrame([(*m, "x", 3) for m in marks], "doc_id long, toxic int, text string, score int")
    out = op.score(odd_documents, labels).collect()
    assert len(out) == odd_documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == folded(r.doc_id) for r in out)
    assert op.score(no_documents, labels).count() == 0


def test_very_long_sentence():
    w = op.split(pa.array(["word " * 50_000]), op.TABLE)
    fld = op.Field(np.zeros(1 << op.BITS), np.array([[1.0, -1], [-1, 1]]), -3.0)
    assert np.isfinite(fld.log_odds(op.features(w), *op.sentences(w))).all()
