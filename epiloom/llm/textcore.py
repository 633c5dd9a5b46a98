"""Words of many texts at once, as 64-bit hashes, with numpy over Arrow buffers.

A batch of texts is walked in slices of about a megabyte, so the working memory
of a task does not depend on the batch, and a single text longer than that is a
slice of its own. Words are runs of bytes of a class that contains every byte of
a non-ASCII character, so byte runs and code point runs are the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


def _cumulative(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        n = max(n, SLICE_BYTES + 65_536)
        _POWERS = _cumulative(_MULTIPLIER, n)
        _INVERSES = _cumulative(_INVERSE, n)
    return _POWERS, _INVERSES


def byte_class(excluded: str | bytes) -> np.ndarray:
    """A table that is True for the bytes that belong to words: all but ``excluded``."""
    table = np.ones(256, bool)
    table[np.frombuffer(excluded if isinstance(excluded, bytes) else excluded.encode("latin-1"), np.uint8)] = False
    return table


WHITESPACE = byte_class(b" \t\n\x0b\x0c\r")
ALPHANUMERIC = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
LETTERS = byte_class(bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


@dataclass
class Slice:
    """Some consecutive texts: rows [first, first + n) of the batch."""

    first: int
    n: int
    data: np.ndarray  # bytes
    offsets: np.ndarray  # n + 1, into data


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a string column; NULL counts as empty."""
    n = len(texts)
    if n == 0:
        return
    wide = pa.types.is_large_string(texts.type)
    if not wide and not pa.types.is_string(texts.type):
        texts, wide = texts.cast(pa.string()), False
    _, at, values = texts.buffers()
    at = np.frombuffer(at, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    starts, ends = at[:-1], at[1:]
    raw = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    if texts.null_count:  # a NULL may cover bytes: give it none
        filled = texts.fill_null("")
        yield from slices(filled, size)
        return
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + size, "right")))
        yield Slice(i, j - i, raw[starts[i] : ends[j - 1]], at[i : j + 1] - at[i])
        i = j


@dataclass
class Words:
    """Words of a slice, in text order."""

    starts: np.ndarray  # byte positions in the slice
    ends: np.ndarray  # exclusive
    bounds: np.ndarray  # n + 1: words of text i are bounds[i]..bounds[i + 1]
    hashes: np.ndarray
    _sums: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, hashes) of the first ``n`` bytes of the words that are longer than ``n``."""
        which = np.flatnonzero(self.ends - self.starts > n)
        s = self.starts[which]
        return which, _range_hash(self._sums, s, s + n)


def _range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverses = _powers(len(sums))
    value = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def words(part: Slice, table: np.ndarray, fold: np.ndarray = FOLD) -> Words:
    """Words are maximal runs of bytes of ``table`` within one text; ``fold`` maps bytes before hashing."""
    data, offsets = part.data, part.offsets
    size = len(data)
    inside = table[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < size]
    opens[first] = inside[first]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    closes[last] = inside[last]
    ends = np.flatnonzero(closes) + 1
    powers, _ = _powers(size + 1)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[fold][data] * powers[:size], out=sums[1:])
    return Words(starts, ends, np.searchsorted(starts, offsets), _range_hash(sums, starts, ends), sums)


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the k-word shingles of each text, in text order and with repeats.

    A text of fewer words, but not none, has its whole sequence as its only shingle.
    """
    h, bounds = found.hashes, found.bounds
    n = np.diff(bounds)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    if not len(h):
        return np.empty(0, np.uint64), out_bounds
    at = np.repeat(bounds[:-1] - out_bounds[:-1], counts) + np.arange(out_bounds[-1])
    room = np.repeat(np.minimum(n, k), counts)  # words in this shingle
    value = room.astype(np.uint64)
    for i in range(k):
        take = h[np.minimum(at + i, len(h) - 1)]
        value = np.where(room > i, mix(value * np.uint64(_MULTIPLIER) + take), value)
    return value, out_bounds


def distinct_per_row(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct values, bounds) of each row of a ragged array."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    v, r = v[keep], r[keep]
    return v, np.searchsorted(r, np.arange(len(bounds)))


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each row of a ragged array (wrapping for unsigned integers)."""
    sums = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def list_array(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    """A list column from a ragged array."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)
