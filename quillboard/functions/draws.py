"""MD5 of many short messages that differ in a counter, in whole arrays: what resampling draws from."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

#: Fixed values of MD5: shifts, constants and start.
SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
SINES = [int(abs(np.sin(k + 1)) * 2**32) for k in range(64)]
START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
ORDER = [k if k < 16 else (5 * k + 1) % 16 if k < 32 else (3 * k + 5) % 16 if k < 48 else 7 * k % 16 for k in range(64)]
#: Messages at once, few enough for the cache; bytes of a message that fit one block.
AT_ONCE, ONE_BLOCK = 1 << 15, 55


def _md5(words: list[np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The four words of the digests, each as its hex digits read as one number; words: 16 arrays that broadcast to the shape."""
    a, b, c, d = (np.full(shape, s, np.uint32) for s in START)
    f, t = np.empty(shape, np.uint32), np.empty(shape, np.uint32)
    for k in range(64):
        turn = k // 16
        if turn == 0:
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
        elif turn == 1:
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
        elif turn == 2:
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        np.add(f, words[ORDER[k]], out=f), np.add(f, np.uint32(SINES[k]), out=f)
        s = SHIFTS[turn][k % 4]
        np.left_shift(f, np.uint32(s), out=t), np.right_shift(f, np.uint32(32 - s), out=f), np.bitwise_or(f, t, out=f)
        np.add(f, b, out=f)
        a, d, c, b, f = d, c, b, f, a
    return np.stack([(x + np.uint32(s)).byteswap() for x, s in zip((a, b, c, d), START, strict=True)])


def _words(rows: np.ndarray, at: int) -> np.ndarray:
    """(16, rows) words of one block that holds the bytes of each row from ``at`` on and nothing else."""
    block = np.zeros((len(rows), 64), np.uint8)
    block[:, at : at + rows.shape[1]] = rows
    return np.ascontiguousarray(block.view("<u4").T)


def _digits(numbers: np.ndarray, places: int) -> np.ndarray:
    return np.stack([numbers // 10 ** (places - 1 - p) % 10 + 48 for p in range(places)], axis=1).astype(np.uint8)


def counted_digests(prefixes: list[bytes], count: int, suffix: bytes = b"") -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(which prefixes, first q, digests (4, prefixes, q)) of prefix + q + suffix for every prefix and q below the count, in pieces."""
    lengths = np.array([len(p) for p in prefixes])
    for length in np.unique(lengths):
        which = np.flatnonzero(lengths == length)
        places = 1
        while (low := 10 ** (places - 1) if places > 1 else 0) < count:
            high, size = min(count, 10**places), int(length) + places + len(suffix)
            wide = max(1, min(high - low, AT_ONCE))
            tall = max(1, AT_ONCE // wide)
            for first in range(low, high, wide):
                q = np.arange(first, min(high, first + wide))
                if size <= ONE_BLOCK:
                    tail = np.frombuffer(suffix + b"\x80", np.uint8)
                    by_q = _words(np.concatenate([_digits(q, places), np.broadcast_to(tail, (len(q), len(tail)))], axis=1), int(length))
                    by_q[14] = 8 * size
                for some in range(0, len(which), tall):
                    rows = which[some : some + tall]
                    if size > ONE_BLOCK:
                        plain = b"".join(hashlib.md5(b"%b%d%b" % (prefixes[r], n, suffix)).digest() for r in rows for n in q.tolist())
                        yield rows, first, np.frombuffer(plain, ">u4").astype(np.uint32).reshape(len(rows), len(q), 4).transpose(2, 0, 1)
                        continue
                    by_row = _words(np.frombuffer(b"".join(prefixes[r] for r in rows), np.uint8).reshape(len(rows), int(length)), 0)
                    if len(rows) == 1:
                        yield rows, first, _md5([c + r[0] if c.any() else r[0] for r, c in zip(by_row, by_q, strict=True)], (len(q),))[:, None, :]
                        continue
                    words = [r[:, None] if not c.any() else c[None, :] if not r.any() else r[:, None] + c[None, :] for r, c in zip(by_row, by_q, strict=True)]
                    yield rows, first, _md5(words, (len(rows), len(q)))
            places += 1


def resampled_sums(prefixes: list[bytes], n: int, low: int, columns: list[np.ndarray], suffix: bytes = b"") -> np.ndarray:
    """(columns, prefixes): sums of the columns' values at n picks out of n for each prefix, of the picks that fall on the values given.

    The k-th pick is the (k % 4)-th eight digits of the digest of prefix, k // 4 and suffix. The columns hold the values from number ``low`` on.
    """
    sums, held = np.zeros((len(columns), len(prefixes))), len(columns[0])
    for rows, first, digests in counted_digests(prefixes, (n + 3) // 4, suffix):
        for part in range(4):
            at = digests[part].astype(np.int64) if n >= 2**31 else digests[part]
            at = at - at // at.dtype.type(n) * at.dtype.type(n)
            last = (n - part + 3) // 4 - first  # how many of these q have this pick
            if last < at.shape[1]:
                at = at[:, : max(last, 0)]
            if held < n:
                at = at.astype(np.intp) - low
                outside = (at < 0) | (at >= held)
                at[outside] = 0
            at = at.astype(np.intp)
            for c, values in enumerate(columns):
                met = values.take(at)
                if held < n:
                    met[outside] = 0.0
                sums[c, rows] += met.sum(axis=1)
    return sums
