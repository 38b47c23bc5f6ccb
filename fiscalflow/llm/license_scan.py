"""License scan: fuzzy search for short notices.

Text is normalized to words (A-Z lower-cased, ASCII punctuation is a gap).  A notice may be
found with up to ``errors`` edits (inserted, dropped or changed characters).  Pigeonhole rule:
cut into ``errors`` + 1 pieces, a notice with at most that many edits keeps at least one piece
unchanged, so the exact pieces of all notices (one Aho-Corasick automaton) find every
candidate place.  There the ``regex`` library matches the whole notice with its error bound
and best-match search, and the span and number of edits are reported.

Beside it, the exact phrases of ``BASE`` are counted word for word.

Defined cases: null is empty; an empty text has no words, no labels and score 0; overlapping
places all count; very long texts are searched whole; extra columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm._common import TEXTS, batches

# fixed values: phrases counted exactly, with their labels
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# fixed values: short notices (normalized words) with their labels
NOTICES = [
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit-grant"),
    ("the software is provided as is without warranty of any kind express or implied", "as-is"),
    ("licensed under the apache license version 2 0", "apache-2.0-notice"),
    ("you may not use this file except in compliance with the license", "apache-2.0-file"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0-notice"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-program"),
    ("gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
]

# everything in ASCII that isn't a letter or digit is a gap; A-Z become a-z
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def normalized(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TABLE).split()


def allowed_errors(notice: str, share: float = 0.1) -> int:
    """A tenth of the notice's characters may differ, at most 8; none in the shortest."""
    return min(8, int(len(notice) * share))


class Notices:
    """Patterns and their seeds."""

    def __init__(self, notices: list[tuple[str, str]], share: float):
        self.found = []
        self.seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (text, label) in enumerate(notices):
            e = allowed_errors(text, share)
            self.found.append((label, len(text), e, regex.compile(rf"(?b)(?:{regex.escape(text, literal_spaces=True)}){{e<={e}}}")))
            size = len(text)
            for i in range(e + 1):
                a, b = size * i // (e + 1), size * (i + 1) // (e + 1)
                self.seeds.setdefault(text[a:b], []).append((k, a))
        self.search = ahocorasick.Automaton()
        for s, at in self.seeds.items():
            self.search.add_word(s, (len(s), at))
        self.search.make_automaton()

    def scan(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(label, start, end, edits, score) in normalized text, the best match at each candidate place."""
        tried, out = set(), []
        for end, (size, at) in self.search.iter(text):
            for k, offset in at:
                label, n, e, pattern = self.found[k]
                first = end + 1 - size - offset
                if (k, first) in tried:
                    continue
                tried.add((k, first))
                # a match that keeps this seed starts within e of first and has at most n + e characters
                if m := pattern.search(text, max(0, first - e), min(len(text), first + n + 2 * e)):
                    edits = sum(m.fuzzy_counts)
                    out.append((label, *m.span(), edits, 1.0 - edits / n))
        return sorted(set(out))


def places(padded: bytes, phrase: bytes) -> list[int]:
    """Starts of the phrase's words in text that has a space before and after each word."""
    out, at, probe = [], -1, b" " + phrase + b" "
    while (at := padded.find(probe, at + 1)) >= 0:
        out.append(at)
    return out


def scan_text(text: str | None, notices: Notices) -> tuple:
    w = normalized(text)
    padded = b" " + b" ".join(w) + b" "
    starts, base = [], set()
    for phrase, label in BASE.items():
        if found := places(padded, phrase.encode()):
            base.add(label)
            starts += [padded.count(b" ", 0, at) for at in found]
    spans = notices.scan(padded[1:-1].decode()) if w else []
    score = max([1.0] * bool(base) + [s[-1] for s in spans], default=0.0)
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {s[0] for s in spans})), score, spans)


SPANS = "array<struct<label:string,first:bigint,end:bigint,edits:bigint,score:double>>"
FIELDS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          f"spans {SPANS}")


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", notices: list[tuple[str, str]] = NOTICES,
                  share: float = 0.1) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and the
    spans of the notices (characters of the normalized text, edits, score)."""
    d = docs.select(F.col(doc_id), F.col(text).cast("string"))
    span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("edits", pa.int64()), ("score", pa.float64())]))
    types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), span]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Notices(notices, share)
        for b in it:
            rows = [scan_text(t, known) for t in b.column(1).to_pylist()]
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types[:-1])]
            cols.append(pa.array([[dict(zip(("label", "first", "end", "edits", "score"), s)) for s in r[-1]] for r in rows], span))
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[doc_id, *names])

    kind = d.schema[doc_id].dataType.simpleString()
    return batches(d, run, f"`{doc_id}` {kind}, {FIELDS}", TEXTS)
