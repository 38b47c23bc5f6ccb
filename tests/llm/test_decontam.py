from __future__ import annotations

import re

from llm.tables import benchmark, documents

from fiscalflow.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, size=13):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(None if i is None else str(i))
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x] - {None}
        out.append((d, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def ours(docs, items, **options):
    c = "__contamination"
    return sorted([(r["doc_id"], r[c]["n_words"], r[c]["n_hit"], tuple(r[c]["items"]), r[c]["contaminated"])
                   for r in decontam.decontaminate(docs, items, **options).collect()], key=str)


def pairs(df, a):
    return [(r[a], r["text"]) for r in df.collect()]


def test_documents(spark):
    d, b = documents(spark, "sf0.01"), benchmark(spark, "sf0.01")
    got = ours(d, b)
    assert got == brute(pairs(d, "doc_id"), pairs(b, "item_id"))
    assert any(x[4] for x in got)


def test_odd_rows_and_short_items(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "the THE"), (2, "a"), (3, None), (4, "!?"), (5, " ".join(["word"] * 20)), (None, "mit license"),
                                   (1, "the the"), (12, "É" * 40), (9, "a")], "item_id long, text string")
    assert ours(odd_documents, items) == brute(pairs(odd_documents, "doc_id"), pairs(items, "item_id"))
    assert ours(odd_documents, items, broadcast_rows=0) == brute(pairs(odd_documents, "doc_id"), pairs(items, "item_id"))
    assert ours(no_documents, items) == []
    assert not any(x[4] for x in ours(odd_documents, items.limit(0)))


def test_capital_sigma(spark):
    """A sigma's small form depends on what follows in the whole text, but not on what follows the word."""
    items = [(1, "\u039f\u0394\u039f\u03a3.\u0391\u0392"), (2, "\u03a3 \u03a3\u0391\u03a3"), (3, "\u03c3\u03b1\u03c2 x")]
    docs = [(1, "\u039f\u0394\u039f\u03a3.\u0391\u0392"), (2, "\u039f\u0394\u039f\u03a3 \u0391\u0392"), (3, "a \u03a3:\u03a3\u0391\u03a3'b"), (4, "\u03a3\u0391\u03a3 X"),
            (5, "\u03c3\u03b1\u03c2 X"), (6, "\u03c3\u03b1\u03c3 x")]
    got = ours(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute(docs, items) and [r[2] for r in got] == [2, 2, 2, 0, 2, 0]
