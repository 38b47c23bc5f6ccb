"""Words of many texts as numpy arrays: split, hashed by prefix polynomials, compared byte by byte."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from fiscalflow.llm import suffix_dedup
from fiscalflow.llm.suffix_dedup import BASE, BYTE, WORD, U, powers, scrambled

for module in (suffix_dedup, sys.modules[__name__]):  # executors may not have them installed
    cloudpickle.register_pickle_by_value(module)

# bytes of text that are held as arrays at once; a longer text is held alone
TEXT_BYTES = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def kinds(gaps: list[int] | range, breaks: list[int] | range = ()) -> np.ndarray:
    """Table of what each byte is: 0 part of a word, 1 between words, 2 between pieces of a text."""
    out = np.zeros(256, np.uint8)
    out[list(gaps)] = 1
    out[list(breaks)] = 2
    if not out[10]:
        raise ValueError("texts are joined by line feeds, so these can't be part of a word")
    return out


# everything but ASCII letters, ASCII digits and what isn't ASCII
NOT_WORD = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most ``limit`` bytes of text or one row; the column must not be null."""
    for b in batches:
        if not len(b):
            continue
        total = np.cumsum(pc.binary_length(b.column(text)).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < len(b):
            before = total[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(total, before + limit, "right")))
            yield b.slice(i, j - i)
            i = j


@dataclass
class Words:
    data: np.ndarray  # lower-cased words, each followed by one space
    start: np.ndarray  # of each word in data
    end: np.ndarray
    doc: np.ndarray  # the number of its text
    piece: np.ndarray  # equal for neighbours in one piece
    at: np.ndarray  # first byte in its own text
    upper: np.ndarray | None  # whether the word began with A-Z

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """A 64-bit polynomial hash of each word."""
        return spans_hashed(self.sums(), self.start, self.end)

    def sums(self) -> np.ndarray:
        """Prefix polynomials of the bytes."""
        n = len(self.data)
        out = np.zeros(n + 1, U)
        np.cumsum(BYTE[self.data] * powers(pow(BASE, -1, WORD), n), out=out[1:])
        return out

    def slices(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The bytes from each word ``first`` to the word ``last``, joined by spaces."""
        size = self.end[last] - self.start[first]
        offsets = np.concatenate(([0], np.cumsum(size)))
        flat = np.repeat(self.start[first] - offsets[:-1], size) + np.arange(offsets[-1])
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.data[flat])])


def split(texts: pa.Array, table: np.ndarray) -> Words:
    """The words of every text; ``table`` from kinds()."""
    rows = texts.cast(pa.binary()).to_pylist()
    offsets = np.concatenate(([0], np.cumsum([len(r) + 1 for r in rows])))
    raw = np.frombuffer(b"\n".join(rows) + b"\n", np.uint8)
    kind = table[raw]
    word = kind == 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word))))
    start, end = edge[0::2], edge[1::2]
    doc = np.searchsorted(offsets, start, "right") - 1
    kept = word.copy()
    kept[end] = True
    data = LOWER[raw]
    data[end] = 32
    size = end - start
    ends = np.cumsum(size + 1) - 1
    return Words(data[kept], ends - size, ends, doc, np.cumsum(kind == 2, dtype=np.int32)[start], start - offsets[doc],
                 (raw[start] >= 65) & (raw[start] <= 90))


def spans_hashed(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; ``sums`` from Words.sums()."""
    return scrambled((sums[end] - sums[start]) * powers(BASE, len(sums))[start])


def same_bytes(a: np.ndarray, start: np.ndarray, end: np.ndarray, b: np.ndarray, start_b: np.ndarray, end_b: np.ndarray,
               rows: int = 100_000) -> np.ndarray:
    """Whether each span of ``a`` holds the same bytes as that of ``b``."""
    out = (end - start) == (end_b - start_b)
    for i in range(0, len(start), rows):
        on = i + np.flatnonzero(out[i:i + rows])
        size = (end - start)[on]
        if not size.sum():
            continue
        cut = np.concatenate(([0], np.cumsum(size)[:-1]))
        within = np.arange(size.sum()) - np.repeat(cut, size)
        equal = a[np.repeat(start[on], size) + within] == b[np.repeat(start_b[on], size) + within]
        out[on] = np.logical_and.reduceat(equal, cut)
    return out


def numbered(words: Words) -> np.ndarray:
    """A number for each word, equal exactly for equal bytes."""
    _, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
    rep = first[number]
    off = np.flatnonzero(~same_bytes(words.data, words.start, words.end, words.data, words.start[rep], words.end[rep]))
    extra: dict[tuple[int, bytes], int] = {}
    for i in off.tolist():  # words of one hash that differ
        key = (int(number[i]), words.data[words.start[i]:words.end[i]].tobytes())
        number[i] = extra.setdefault(key, len(first) + len(extra))
    return number
