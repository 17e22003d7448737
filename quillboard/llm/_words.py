"""Exact words of many texts at once, as Arrow arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from quillboard.llm._arrow import LOWER, SPACE

#: Bytes outside terms: all of ASCII but its letters.
NOT_LETTERS = np.zeros(256, bool)
NOT_LETTERS[:128] = True
NOT_LETTERS[65:91] = NOT_LETTERS[97:123] = False


def cut(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = SPACE, fold: bool = False, spaced: bool = False) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of the rows data[offsets[k]:offsets[k + 1]] and the n + 1 bounds of each row's words.

    A word is a longest stretch of bytes that ``outside`` does not name; none crosses
    rows. ``fold`` lower-cases A-Z; ``spaced`` puts one space after each word.
    """
    base, data = offsets[0], data[offsets[0] : offsets[-1]]
    inside = ~outside[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets - base] = True
    after = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    begins = inside & (first[:-1] | ~after)
    starts = np.flatnonzero(begins)
    bounds = np.searchsorted(starts, offsets - base)
    where = np.flatnonzero(inside)
    at = np.searchsorted(where, starts)  # of each word's first byte among the kept bytes
    step = 1 if spaced else 0
    out = np.full(len(where) + step * len(starts), 32, np.uint8)
    kept = LOWER[data[where]] if fold else data[where]
    out[np.arange(len(where)) + step * (np.cumsum(begins)[where] - 1) if spaced else slice(None)] = kept
    ends = np.append(at, len(where)) + step * np.arange(len(starts) + 1)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)]), bounds


def codes(words: pa.LargeBinaryArray) -> tuple[np.ndarray, pa.Array]:
    """The number of each word among the distinct words, and these."""
    found = words.dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary
