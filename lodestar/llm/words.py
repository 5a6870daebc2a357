"""Words and word windows of a batch of texts as numpy arrays.

A word is a maximal run of bytes other than space and tab to carriage return
(ASCII, so no byte of another UTF-8 character is mistaken for one).  Words and
windows are named by polynomial hashes modulo 2**64, finished by a mixer; a
second lane with another base makes them 128-bit names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
# Odd 64-bit multipliers (two byte lanes, two word lanes).
BYTE_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
WORD_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept between calls while small)."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, U)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if n <= 1 << 19:
            _powers[base] = held
    return held[:n]


def ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Mixed polynomial hash of values[start:end] for each range; equal contents, equal hash."""
    n = len(values)
    sums = np.zeros(n + 1, U)
    np.cumsum(values * powers(base, n), out=sums[1:])
    down = powers(pow(base, -1, 1 << 64), n + 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))


@dataclass
class Words:
    """``data``: the texts' bytes one after the other; word w is data[start[w]:end[w]] and
    text t has words first[t]:first[t + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self, lane: int = 0) -> np.ndarray:
        return ranges(self.data.astype(U) + U(1), self.start, self.end, BYTE_BASES[lane])

    def texts_of_words(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, w: int) -> bytes:
        return self.data[self.start[w]:self.end[w]].tobytes()


def split(texts: pa.Array) -> Words:
    """The words of a string array; null texts have none."""
    column = texts.cast(pa.large_binary())
    size = len(column)
    offsets = np.frombuffer(column.buffers()[1], "<i8")[column.offset:column.offset + size + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body is not None and size else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if size else np.zeros(1, np.int64)
    inside = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begin[cuts] |= inside[cuts]  # a text's first byte starts a word, the byte before ends one
    stop[cuts - 1] |= inside[cuts - 1]
    if texts.null_count:  # bytes under a null are no text
        empty = texts.is_null().to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(empty):
            begin[offsets[i]:offsets[i + 1]] = False
            stop[offsets[i]:offsets[i + 1]] = False
    start = np.flatnonzero(begin)
    end = np.flatnonzero(stop) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def windows(words: Words, hashes: np.ndarray, width: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every run of ``width`` words that lies in one text."""
    text = words.texts_of_words()
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, U)
    at = np.flatnonzero(text[:n - width + 1] == text[width - 1:])
    return at, ranges(hashes, at, at + width, WORD_BASES[lane])


def text_slices(column: pa.Array, most: int = 400_000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text each (one row at least)."""
    import pyarrow.compute as pc

    if not len(column):
        return
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + most, "right")))
        yield lo, hi
        lo = hi
