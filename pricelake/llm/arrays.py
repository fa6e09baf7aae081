"""Texts of an Arrow column as flat NumPy arrays: words, hashes and shingles without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that one round of array work takes; a longer text is a round of its own.
ROUND_BYTES = 1 << 20
ROUND_ROWS = 2048

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Words(NamedTuple):
    """Byte range and hash of every word; ``bounds[i]:bounds[i + 1]`` are the words of text i."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray


def rounds(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of slices of a string column; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + ROUND_BYTES, side="right")) - 1
        to = min(max(to, at + 1), at + ROUND_ROWS, len(column))
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def ranges_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, from one running sum."""
    power, inverse = _power(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs of bytes other than blank, tab, line feed, vertical tab, form feed and return."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = np.flatnonzero(inside[1:-1] & (first[:-1] | ~inside[:-2]))
    end = np.flatnonzero(inside[1:-1] & (first[1:] | ~inside[2:])) + 1
    return Words(start, end, ranges_hash(data, start, end), np.searchsorted(start, offsets))


def owners(bounds: np.ndarray) -> np.ndarray:
    """The text of each item, given the items' bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` words, by text, and their bounds; a shorter text with words is one shingle."""
    n = np.diff(bounds)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    to = np.concatenate(([0], np.cumsum(count)))
    doc = owners(to)
    at = np.arange(to[-1]) - to[doc] + bounds[doc]
    last = bounds[1:][doc]
    total = np.zeros(len(at), np.uint64)
    for j in range(width):
        here = at + j < last
        word = np.where(here, hashes[np.minimum(at + j, max(len(hashes) - 1, 0))], np.uint64(j + 1)) if len(at) else total
        total = mix(total * _STEP + word)
    order = np.argsort(total)
    order = order[np.argsort(doc[order].astype(np.uint16 if len(n) < 65536 else np.int64), kind="stable")]
    total, doc = total[order], doc[order]
    new = np.ones(len(total), bool)
    new[1:] = (total[1:] != total[:-1]) | (doc[1:] != doc[:-1])
    return total[new], np.searchsorted(doc[new], np.arange(len(n) + 1))


def table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
