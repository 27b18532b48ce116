"""Words of whole texts as numpy arrays, one Arrow slice at a time.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. These are ASCII, so
words of UTF-8 text can be found on bytes. A slice holds whole texts only: several
small ones or one long one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += 0x20
_SAME = np.arange(256, dtype=np.uint64)

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; the table doubles as it grows."""
    return _power_table(base, max(1 << 12, 1 << (max(n, 1) - 1).bit_length()))[:n]


@lru_cache(maxsize=8)
def _power_table(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        np.multiply.accumulate(np.full(n - 1, base, np.uint64), out=out[1:])
    return out


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have at most ``limit`` bytes together, or one row."""
    if not batch.num_rows:
        return
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


class Words:
    """Words of an array of texts; a null text has none.

    ``data`` holds all texts' bytes, ``bounds`` the texts' limits in it; word ``i``
    is ``data[starts[i]:ends[i]]`` and belongs to text ``text[i]``, whose words are
    ``first[t]:first[t + 1]``.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("")
        if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
            kind = np.int64
        else:
            kind = np.int32
        n = len(texts)
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = raw[bounds[0] : bounds[-1]]
        self.bounds = bounds - bounds[0]
        self.inside = ~_SPACE[self.data]
        begins = self.inside.copy()
        begins[1:] &= ~self.inside[:-1]
        heads = self.bounds[:-1][self.bounds[:-1] < self.bounds[1:]]
        begins[heads] = self.inside[heads]
        stops = self.inside.copy()
        stops[:-1] &= ~self.inside[1:]
        tails = heads[heads > 0] - 1
        stops[tails] = self.inside[tails]
        if len(stops):
            stops[-1] = self.inside[-1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, self.bounds)
        self.text = np.repeat(np.arange(n), np.diff(self.first))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """The number of set bytes of each text."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; ``lower`` reads A-Z as a-z."""
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, np.uint64)
        begin = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(begin, lengths)
        with np.errstate(over="ignore"):
            values = (_LOWER if lower else _SAME)[self.data[self.inside]] + np.uint64(1)
            values *= _powers(_BYTE_BASE, int(lengths.max()))[place]
            return mix(np.add.reduceat(values, begin) + lengths.astype(np.uint64) * np.uint64(_WORD_BASE))

    def windows(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and 64-bit hash of every run of ``n`` words inside one text."""
        if len(hashes) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[: len(hashes) - n + 1] == self.text[n - 1 :])
        inverse = pow(_WORD_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_WORD_BASE, len(hashes)), dtype=np.uint64)])
            return at, mix((sums[at + n] - sums[at]) * _powers(inverse, len(hashes))[at])

    def sequences(self, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the words ``begin[i]:end[i]``, the same wherever they stand."""
        inverse = pow(_WORD_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_WORD_BASE, len(hashes)), dtype=np.uint64)])
            shift = _powers(inverse, len(hashes) + 1)[begin]
            return mix((sums[end] - sums[begin]) * shift + mix((end - begin).astype(np.uint64)))

    def identities(self, hashes: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each text's words."""
        return self.sequences(hashes, self.first[:-1], self.first[1:])


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of ``n`` places lie in any of the given runs."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + lengths, n), -1)
    return np.cumsum(change[:-1]) > 0
