"""Words of Arrow text columns as numpy arrays: offsets, hashes and hashes of word runs.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``. Texts are taken
whole; work goes on in slices of whole rows, so memory follows the longest text and
not the batch. All hashes are fixed functions of the bytes, alike on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over the others."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(base, n), powers(pow(base, -1, 1 << 64), n)


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * U(_STEP))


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets into the bytes); null counts as empty."""
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if len(column) == 0:
        return
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the number of words before it."""
    word = ~blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], word])
    starts = np.flatnonzero(word & (~before[:-1] | edge[:-1]))
    ends = np.flatnonzero(before[1:] & (~np.concatenate([word[1:], [False]]) | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word, from its bytes alone."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + SLICE, "right")))
        first = starts[lo]
        part = data[first : ends[hi - 1]]
        up, down = _tables(_BASE, len(part) + 1)
        total = np.concatenate([[U(0)], np.cumsum(_BYTES[part] * up[:-1])])
        out[lo:hi] = (total[ends[lo:hi] - first] - total[starts[lo:hi] - first]) * down[starts[lo:hi] - first]
        lo = hi
    return mix(out + (ends - starts).astype(np.uint64))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for every run of k consecutive words (one for each start)."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for j, p in enumerate(powers(_STEP, k)):
        out += hashes[j : j + n] * p
    return mix(out)


def run_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each run of words [start, end), independent of ``grams``."""
    up, down = _tables(_BASE, len(hashes) + 1)
    total = np.concatenate([[U(0)], np.cumsum(mix(hashes) * up[:-1])])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
