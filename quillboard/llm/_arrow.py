"""Arrow and numpy helpers that run inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its len + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def chunks(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer row is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: One random-looking word for each byte value, so that byte hashes do not add up alike.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0xD1342543DE82EF95)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        for k, b in enumerate((BASE, INVERSE)):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: the hash of data[s:e] is (p[e] - p[s]) * BASE**-s."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(len(data))[0], out=out[1:])
    return out


#: White space that ends a word, and the fold of A-Z.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray, block: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of each row, and the n + 1 bounds of the rows' words.

    Works block by block of bytes, so a very long text needs little more than its own size.
    """
    base, data = offsets[0], data[offsets[0] : offsets[-1]]
    inside = np.zeros(len(data) + 1, bool)
    np.logical_not(SPACE[data], out=inside[:-1])
    first = np.zeros(len(data) + 1, bool)
    first[offsets - base] = True
    after = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (first | ~after))
    ends = np.flatnonzero(after & (first | ~inside))
    bounds = np.searchsorted(starts, offsets - base)
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + block, "right")))
        lo = starts[i]
        p = prefix_hash(LOWER[data[lo : ends[j - 1]]])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((p[e] - p[s]) * powers(len(p))[1][s] + (e - s).astype(np.uint64))
        i = j
    return out, bounds
