"""Words of Arrow string columns as 64-bit keys, without a Python loop over words.

A word's key is a polynomial over random 64-bit codes of its bytes, mixed at the end. Equal words
have equal keys; V different words share one with probability V * V / 2**65. Prefix sums give all
words of a segment at once. Segments are cut at separators, so memory is bounded for texts of any
length, apart from eight bytes per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
_U = np.uint64
_random = np.random.default_rng(20240229)
_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = int(0x9E3779B97F4A7C15)
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, _U), np.full(n - 1, base, _U)]), dtype=_U)


_UP, _DOWN = _powers(_BASE, SEGMENT + 1), _powers(_INVERSE, SEGMENT + 1)


def _folding(separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By byte: whether it belongs to a word, its code, and what it is folded to."""
    is_word = np.ones(256, bool)
    is_word[list(separators)] = False
    folded = np.arange(256, dtype=np.int32)
    if lower:
        folded[65:91] += 32
    return is_word, _CODES[folded], folded


WHITE = bytes([32, *range(9, 14)])
#: Everything in ASCII that is neither a letter nor a digit.
NOT_ALPHANUMERIC = bytes(b for b in range(128) if not chr(b).isalnum())
SPACED = _folding(WHITE, lower=True)
ALPHANUMERIC = _folding(NOT_ALPHANUMERIC, lower=True)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def key_of(word: bytes, folding=SPACED) -> int:
    """The key of one word, for tests and fixed words."""
    keys = words(pa.array([word.decode()]), folding).keys
    assert len(keys) == 1
    return int(keys[0])


@dataclass
class Words:
    """Keys of all words of a column; those of row i lie from offsets[i] to offsets[i + 1]."""

    offsets: np.ndarray
    keys: np.ndarray
    endings: np.ndarray | None = None

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(offsets) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(column: pa.Array, folding=SPACED, forms: bool = False) -> Words:
    """Words of each row; ``forms`` adds ``endings``.

    An ending is the last byte, plus 256 times the byte before it (0 if there is none), plus 2**16
    if any byte is beyond ASCII.
    """
    is_word, codes, folded = folding
    data, offsets = string_parts(column)
    if not len(data):
        return Words(np.zeros(len(offsets), np.int64), np.zeros(0, _U), np.zeros(0, np.int32))
    keys, starts, endings, at = [], [], [], 0
    while at < len(data):
        stop = _cut(data, offsets, is_word, at)
        part = data[at:stop]
        inside = is_word[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        borders = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop)] - at
        first[borders] = inside[borders]
        begin = np.flatnonzero(first)
        # a word ends where the next byte is outside, starts another word, or there is none
        final = inside.copy()
        final[:-1] &= ~inside[1:] | first[1:]
        end = np.flatnonzero(final) + 1
        up, down = (_UP, _DOWN) if len(part) <= SEGMENT else (_powers(_BASE, len(part) + 1), _powers(_INVERSE, len(part) + 1))
        sums = np.zeros(len(part) + 1, _U)
        np.cumsum(codes[part] * up[: len(part)], out=sums[1:])
        keys.append(mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(_U)))
        starts.append(begin + at)
        if forms:
            beyond = np.zeros(len(part) + 1, np.int32)
            np.cumsum(part >= 128, out=beyond[1:])
            before = np.where(end - begin > 1, folded[part[np.maximum(end - 2, 0)]], 0)
            endings.append(folded[part[end - 1]] + (before << 8) + ((beyond[end] > beyond[begin]).astype(np.int32) << 16))
        at = stop
    all_starts = np.concatenate(starts)
    return Words(
        np.searchsorted(all_starts, offsets).astype(np.int64),
        np.concatenate(keys),
        np.concatenate(endings) if forms else None,
    )


def _cut(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, at: int) -> int:
    """Where the segment from ``at`` may end: behind a separator or at a row's border."""
    if len(data) - at <= SEGMENT:
        return len(data)
    for reach in (SEGMENT, len(data) - at):
        border = offsets[np.searchsorted(offsets, at + reach, "right") - 1]
        window = data[max(at, at + reach - 4096) : at + reach] if reach == SEGMENT else data[at + SEGMENT : at + reach]
        gaps = np.flatnonzero(~is_word[window])
        if reach == SEGMENT:
            gap = at + reach - len(window) + gaps[-1] + 1 if len(gaps) else at
            if max(gap, border) > at:
                return int(max(gap, border))
        else:
            gap = at + SEGMENT + gaps[0] + 1 if len(gaps) else len(data)
            after = np.searchsorted(offsets, at, "right")
            return int(min(gap, offsets[after]))
    return len(data)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, keys) of each row's shingles in order; fewer words give one of them all."""
    counts = np.diff(found.offsets)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(n)])
    if not offsets[-1]:
        return offsets, np.zeros(0, _U)
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - found.offsets[:-1], n)
    whole = np.repeat(counts, n)
    total = np.zeros(len(at), _U)
    for k in range(size):
        key = found.keys[np.minimum(at + k, len(found.keys) - 1)]
        total = mixed(total + np.where(k < whole, key, _U(0)) + _U(k + 1))
    return offsets, total


def distinct_by_row(offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each row, ascending: (offsets, keys)."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    counts = np.bincount(rows[fresh], minlength=len(offsets) - 1)
    return np.concatenate([[0], np.cumsum(counts)]), keys[fresh]


def slices(column: pa.Array, most: int = 8 * SEGMENT) -> Iterator[tuple[int, int]]:
    """Row ranges of a column that hold about ``most`` bytes each, one row at least."""
    _, offsets = string_parts(column)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop
        start = stop
