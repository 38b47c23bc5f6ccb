"""Collocations against counts of every n-gram."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fiscalflow.llm import _words
from fiscalflow.llm import collocations as op

PIECE = re.compile("[.,;:!?\x0A-\x0D]")
WORD = re.compile("[^\x20\x09]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, max_words=3, least=10, top=2000, covered=50):
    f, n = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(LOWER)):
            w = WORD.findall(piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, _, l, r = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(kept)[:top])]
    return sorted(out)


def rows(df):
    return sorted(tuple(r)[:8] for r in df.collect())


def texts(seed, n=300):
    rng = random.Random(seed)
    vocabulary = ["A", "b", "ç", "É", "d\x00e", "ff", "Ggg", "hh-h"]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", " \x0b"]
    return [(rng.choice(["en", "en", "fr", None, "und", ""]), "".join(x for _ in range(rng.randrange(40)) for x in (rng.choice(vocabulary), rng.choice(gaps))))
            for _ in range(n)] + [("en", None), (None, "")]


def frame(spark, docs):
    return spark.createDataFrame([(i, l, t) for i, (l, t) in enumerate(docs)], "doc_id long, lang string, text string").repartition(3)


@pytest.mark.parametrize("max_words, bits, top", [(3, 64, 2000), (3, 6, 2000), (4, 64, 7), (2, 10, 3)])
def test_brute_force(spark, max_words, bits, top):
    """Also with fingerprints of so few bits that all collide, and a filter that is full."""
    docs = texts(max_words + bits)
    got = op.mine(frame(spark, docs), max_words=max_words, bits=bits, top=top, filter_bits=1 << 15, hold=1000, part_bytes=500)
    assert rows(got) == brute(docs, max_words, top=top)


def test_pointers(spark):
    docs = [("en", "x, Big  Cat y")] * 12 + [("en", "é big cat")]
    got = {r.phrase: (r.first_doc, r.first_byte) for r in op.mine(frame(spark, docs)).collect()}
    assert got == {"big cat y": (0, 3)}  # it accounts for 12 of 13 "big cat"


def test_products_beyond_64_bits(spark):
    c = 4_000_000_000_000
    counts = spark.createDataFrame([("en", "a b", 2, c - 3, 0, 0), ("en", "a", 1, c, 0, 0), ("en", "b", 1, c + 7, 0, 0)],
                                   "lang string, phrase string, words int, c long, doc long, at long")
    assert [r.score for r in op.scored(counts).collect()] == [1000000 * (c - 3) ** 2 // (c * (c + 7))]


def test_words_are_compared():
    """Numbers of words stay exact where hashes are equal."""
    w = _words.split(pa.array(["aa bb aa", "cc bb dd"]), op.TABLE)
    w.hashes = lambda: np.zeros(len(w), np.uint64)
    got = _words.numbered(w).tolist()
    assert got[0] == got[2] and got[1] == got[4] and len(set(got)) == 4


def test_odd_rows(spark, odd_documents, no_documents):
    assert op.mine(no_documents).count() == 0
    docs = [(r.lang, r.text) for r in odd_documents.collect()]
    assert rows(op.mine(odd_documents, least=2)) == brute(docs, least=2)
