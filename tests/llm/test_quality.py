from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from llm.tables import documents

from fiscalflow.llm import quality_js as q


def brute_base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) for k in range(3) if grams[tuple(w[i:i + 3])] > 1}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def check(df):
    rows = q.quality_rules(df).collect()
    for r in rows:
        got = r[-1]
        assert brute_base(r["text"]) == tuple(got)[:6]
        assert got["kept"] is False or not got["base_failed"]
    return rows


def test_documents_and_references(spark):
    d = documents(spark, "sf0.01")
    rows = check(d)
    # the reference is the mean over all documents of the language, by plain counting
    mean, seen = {}, {}
    for r in rows:
        p = plain_classes(r["text"] or "")
        if r["lang"] is not None and r[-1]["n_words"] >= 50 and p.sum():
            mean[r["lang"]] = mean.get(r["lang"], 0) + p / p.sum()
            seen[r["lang"]] = seen.get(r["lang"], 0) + 1
    got = q.language_references(d)
    for lang, total in mean.items():
        assert np.allclose(got[(lang, "chars")], total / seen[lang], atol=1e-8)
    # each document's distance to it, by the definition of the divergence
    measured = [r for r in rows if r[-1]["n_words"] >= 50 and r["lang"] in mean]
    for r in measured:
        p, m = plain_classes(r["text"]), mean[r["lang"]] / seen[r["lang"]]
        assert abs(r[-1]["char_distance"] - plain_distance(p / p.sum(), m / m.sum())) < 1e-6
        over = r[-1]["char_distance"] > 0.30 or (r[-1]["word_distance"] or 0) > 0.32
        assert r[-1]["kept"] == (not r[-1]["base_failed"] and not over)
    assert len(measured) > 500


def plain_distance(p, q_):
    """Root of the Jensen-Shannon divergence in bits."""
    m = [(a + b) / 2 for a, b in zip(p, q_)]
    bits = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a > 0)
    return math.sqrt(max(0.0, (bits(p) + bits(q_)) / 2))


def plain_classes(text):
    """Counts of the character classes, a character at a time."""
    def name(c):
        if c >= "\x80":
            return "letter"
        if c.isalpha():
            return "lower" if c.islower() else "upper"
        if c.isdigit():
            return "digit"
        if c in "\t\n\v\f\r ":
            return "space"
        if c in ".,;:'\"-!?()":
            return "stop"
        if c < " " or c == "\x7f":
            return "control"
        return "symbol" if c in "#*$%&|<>" else "mark"

    n = Counter(map(name, text))
    return np.array([float(n[c]) for c in q.CLASSES if c != "rest"])


def test_labels_agree(spark):
    d = documents(spark, "sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    n = Counter(map(tuple, q.quality_rules(d).where("not __quality.base_failed").select("quality", "__quality.kept").collect()))
    assert n[(1, False)] <= 0.002 * n[(1, True)]
    assert n[(0, False)] >= 0.8 * (n[(0, False)] + n[(0, True)])


def test_odd_rows(odd_documents, no_documents):
    check(odd_documents)
    assert q.quality_rules(no_documents).count() == 0


def test_js_distance_bounds():
    assert q.js_distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1.0
    assert q.js_distance(np.array([2.0, 4]), np.array([1.0, 2])) == 0.0


def test_languages_without_a_word_list_have_their_own_reference(spark):
    words = "в лесу родилась ёлочка она росла зимой и летом стройная зелёная была метель ей пела песенку спи бай мороз снежком укутывал".split()
    clean = [" ".join(random.Random(i).choices(words, k=120)) + "." for i in range(12)]
    english = [r["text"] for r in documents(spark, "sf0.01").where("lang = 'en'").limit(200).collect()]
    rows = [(t, "ru") for t in clean] + [(t, None) for t in clean] + [(t, "en") for t in english]
    rows += [(" ".join(f"{chr(97 + i % 26)}# ${i}" for i in range(200)), "ru")]
    d = spark.createDataFrame(rows, "text string, lang string")
    got = check(d)
    base_ok = [r for r in got if not r[-1]["base_failed"]]
    assert [r["lang"] for r in base_ok].count("ru") >= 10 and [r["lang"] for r in base_ok].count(None) >= 10
    for r in base_ok:
        if r["lang"] is None:
            assert r[-1]["char_distance"] is None and r[-1]["kept"]
        elif r["lang"] == "ru":
            assert r[-1]["kept"] == ("#" not in r["text"])
    # joined by shuffle, and without a language column
    again = q.judge(d, q.saved(q.reference_rows(d)), broadcast_rows=0).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert all(r[-1]["char_distance"] is None for r in q.quality_rules(d.drop("lang")).collect())
