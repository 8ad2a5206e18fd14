"""Numpy work on the text column of an Arrow batch, shared by the operators.

A column is taken as its UTF-8 bytes and the offsets of its rows. NULL counts as the empty text.
Long columns are handled in blocks of rows, long texts whole, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once.
BLOCK = 1 << 20
# Bytes hashed at once; the working arrays are eight times as large and stay in the cache.
HASHED = 1 << 15

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Everything in ASCII that is neither a letter nor a digit.
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate(([np.uint64(1)], np.cumprod(np.full(n - 1, base), dtype=np.uint64)))


_UP, _DOWN = _powers(_ODD, HASHED + 1), _powers(_INVERSE, HASHED + 1)


def fold(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case; every other character as it is."""
    low = LOWER[data]
    accented = np.flatnonzero(data[:-1] == 0xC3) + 1
    upper = accented[(data[accented] <= 0x9E) & (data[accented] != 0x97)]
    low[upper] += 0x20
    return low


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def row_blocks(offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of about `size` bytes, one row at least."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def string_blocks(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, list[str]]]:
    """Row ranges with their texts, NULL as the empty text."""
    _, offsets = utf8(column)
    for lo, hi in row_blocks(offsets, size):
        yield lo, hi, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between `gap` bytes, and where each row's words begin."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    blank = gap[data]
    before = np.empty(n, bool)
    before[0], before[1:] = True, blank[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = True
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, blank[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    starts = np.flatnonzero(before & ~blank)
    ends = np.flatnonzero(after & ~blank) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges that follow each other without overlap; equal bytes, equal hash."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        base = starts[lo]
        hi = int(np.searchsorted(ends, base + HASHED, "right"))
        if hi <= lo:  # one range longer than the tables
            out[lo] = _long_hash(data[base : ends[lo]])
            lo += 1
            continue
        n = int(ends[hi - 1] - base)
        run = np.empty(n + 1, np.uint64)
        run[0] = 0
        np.cumsum(_BYTE[data[base : base + n]] * _UP[:n], out=run[1:])
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = (run[e] - run[s]) * _DOWN[s]
        lo = hi
    return mix(out + (ends - starts).astype(np.uint64))


def _long_hash(piece: np.ndarray) -> np.uint64:
    total, scale = 0, 1
    step = pow(int(_ODD), HASHED, 1 << 64)
    for lo in range(0, len(piece), HASHED):
        part = piece[lo : lo + HASHED]
        total = (total + scale * int((_BYTE[part] * _UP[: len(part)]).sum(dtype=np.uint64))) & (2**64 - 1)
        scale = scale * step & (2**64 - 1)
    return np.uint64(total)


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each item, from where each row's items begin."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def distinct_per_row(bounds: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, from where each row's values begin; sorts `values` in place."""
    at = bounds.tolist()
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        if hi - lo > 1:
            values[lo:hi].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[bounds[:-1][bounds[:-1] < len(values)]] = True
    return values[new], np.concatenate(([0], np.cumsum(new)))[bounds]


def distinct_packed(rows: np.ndarray, values: np.ndarray, bits: int, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """As above for values below 2**bits, by one sort over row and value."""
    key = rows.astype(np.int64) << bits | values.astype(np.int64)
    key.sort()
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    return key & ((1 << bits) - 1), np.searchsorted(key >> bits, np.arange(n_rows + 1))


def sum_rows(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over each row's items, 0 for none; `values` may have a second dimension."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), np.float64)
    held = np.flatnonzero(np.diff(bounds))
    if len(held):
        out[held] = np.add.reduceat(values, bounds[:-1][held], axis=0)
    return out
