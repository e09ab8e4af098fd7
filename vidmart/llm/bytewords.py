"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Words are runs of bytes other than ASCII white space; A-Z count as a-z. No step loops over
words or bytes in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n + 1:
        size = max(n + 1, 1 << 16)
        both = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


def folding() -> np.ndarray:
    """Byte to byte: A-Z to a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


def text_slices(column: pa.Array, most: int = SLICE_BYTES):
    """(first row, byte buffer, offsets) of runs of rows with about ``most`` bytes, or one row."""
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; ``offsets`` bound the rows in ``data``."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    letter = ~spaces()[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begins = letter.copy()
    begins[1:] &= ~letter[:-1] | first[1:n]
    ends = letter.copy()
    ends[:-1] &= ~letter[1:] | first[1:n]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(ends) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, stops, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, with A-Z folded."""
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)  # worked out in place: every array has 8 bytes for one of the text
    sums[1:] = folding()[data]
    sums[1:] += np.uint64(1)
    sums[1:] *= power[: len(data)]
    np.cumsum(sums[1:], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * inverse[starts])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word."""
    starts, stops, rows = word_spans(data, offsets)
    return span_hashes(data, starts, stops), rows


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words by row, sorted by row and hash, with row bounds.

    A row with fewer words has its whole sequence as its one shingle; a row without words none.
    """
    m = len(hashes)
    counts = np.bincount(rows, minlength=n_rows)
    total = np.zeros(max(m - size + 1, 0), np.uint64)
    for k in range(size):
        total = mix(total + hashes[k : k + len(total)] + np.uint64(k + 1))
    whole = rows[: len(total)] == rows[size - 1 :][: len(total)] if len(total) else np.zeros(0, bool)
    keys, of = total[whole], rows[: len(total)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])[short]
        value = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            more = counts[short] > k
            at = np.minimum(first + k, m - 1)
            value = np.where(more, mix(value + hashes[at] + np.uint64(k + 101)), value)
        keys, of = np.concatenate([keys, value]), np.concatenate([of, short])
    order = np.lexsort((keys, of))
    keys, of = keys[order], of[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    keys, of = keys[fresh], of[fresh]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n_rows))])
    return keys, bounds
