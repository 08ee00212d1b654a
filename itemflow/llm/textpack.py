"""Whole text columns as one byte array: words, lines, shingles and hashes without a Python step per word.

Used inside ``mapInArrow``. Texts are taken in pieces of about a megabyte of whole texts, so
that memory follows the longest text and never the batch. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20

#: Byte classes of the words that the operators take.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_M1, _M2, _FOLD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0xD6E8FEB86659FD93)
_S = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of a public hash)."""
    shifted = x >> _S
    x = x ^ shifted
    x *= _M1
    x ^= np.right_shift(x, _S, out=shifted)
    x *= _M2
    x ^= np.right_shift(x, _S, out=shifted)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _POWERS[i] = np.multiply.accumulate(row)
    return _POWERS[0][:n], _POWERS[1]


@dataclass
class Texts:
    """Some texts of a column: ``buf[starts[i]:ends[i]]`` is text ``i``, row ``row + i`` of its batch."""

    buf: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: int

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def rows(self) -> slice:
        return slice(self.row, self.row + len(self.starts))

    def lowered(self) -> Texts:
        """A-Z in lower case; other bytes stay."""
        return Texts(LOWER[self.buf], self.starts, self.ends, self.row)

    def runs(self, member: np.ndarray) -> Spans:
        """Runs of bytes with ``member[byte]``; none goes over the end of a text."""
        inside = member[self.buf]
        n = len(inside)
        if not n:
            return Spans(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self) + 1, np.int64))
        full = self.ends > self.starts
        edge = np.zeros(n + 1, bool)
        edge[1:n] = inside[1:] != inside[:-1]
        edge[self.starts[full]] = True
        edge[n] = True
        begin = np.flatnonzero(edge[:n] & inside)
        after = np.zeros(n + 1, bool)
        after[1:] = edge[1:] & inside
        return Spans(begin, np.flatnonzero(after), self.index(begin))

    def lines(self) -> Spans:
        r"""The parts between ``\n``, as many as line ends and one more for each text."""
        at = np.flatnonzero(self.buf == 10)
        begin = np.sort(np.concatenate([self.starts, at + 1]), kind="stable")
        end = np.sort(np.concatenate([self.ends, at]), kind="stable")
        counts = np.searchsorted(at, self.ends) - np.searchsorted(at, self.starts) + 1
        return Spans(begin, end, np.concatenate([[0], np.cumsum(counts)]))

    def index(self, sorted_starts: np.ndarray) -> np.ndarray:
        """Number of the first span of each text, and at last how many spans there are."""
        return np.append(np.searchsorted(sorted_starts, self.starts), len(sorted_starts))

    def totals(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        before = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return before[self.ends] - before[self.starts]

    def hasher(self) -> Hasher:
        return Hasher(self.buf)


@dataclass
class Spans:
    """Stretches of texts; those of text ``i`` are ``first[i]`` up to ``first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


class Hasher:
    """64-bit hashes of any stretches of a byte array, from one running sum."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        powers, self.back = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        terms = buf.astype(np.uint64)
        terms += np.uint64(1)
        terms *= powers[:n]
        np.cumsum(terms, out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def neighbours(self, at: np.ndarray, size: int) -> np.ndarray:
        """Of the stretches from each place to the one that comes ``size`` places later."""
        sums = self.sums[at]
        return mix((sums[size:] - sums[:-size]) * self.back[at[:-size]])


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and text of each window of ``size`` neighbouring spans that stays in one text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    step = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[text] + step, text


def folded(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """One hash for each ``size`` neighbouring values, in order."""
    out = np.full(len(at), size, np.uint64)
    for k in range(size):
        out = out * _FOLD + values[at + k]
    return mix(out)


def shingles(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle of ``size`` words, by text; fewer words, but not none, are one shingle."""
    at, text = windows(first, size)
    hashes = folded(words, at, size)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        for k in range(1, size):
            some = short[counts[short] == k]
            hashes = np.concatenate([hashes, folded(words, first[some], k)])
            text = np.concatenate([text, some])
        order = np.argsort(text, kind="stable")
        hashes, text = hashes[order], text[order]
    return hashes, text


def distinct(values: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, and the index of its first."""
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[new], text[new]
    return values, np.searchsorted(text, np.arange(n + 1))


def set_hash(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash for each text's set of values; 0 for an empty set only."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ _FOLD), dtype=np.uint64)])
    again = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values + _M1), dtype=np.uint64)])
    out = mix((sums[first[1:]] - sums[first[:-1]]) * _FOLD + (again[first[1:]] - again[first[:-1]]))
    return np.where(np.diff(first) > 0, np.maximum(out, np.uint64(1)), np.uint64(0))


def pieces(column: pa.Array, most: int = PIECE) -> Iterator[Texts]:
    """Cut a string column into runs of whole texts of at most ``most`` bytes, or one longer text."""
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # what lies below a null is no text
        column = column.fill_null("")
        yield from pieces(column, most)
        return
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        low = offsets[at]
        yield Texts(data[low : offsets[to]], offsets[at:to] - low, offsets[at + 1 : to + 1] - low, at)
        at = to


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return values.view(np.int64)
