"""Word-shingle sets of many texts at once, as sorted 64-bit hashes.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a
text's set holds its distinct ``words``-word shingles, or its whole word
sequence when it has fewer words, or nothing without words."""

from __future__ import annotations

import numpy as np

from .common import mix64

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _byte_table() -> tuple[np.ndarray, np.ndarray]:
    """A fixed pseudo-random number per byte (white space: 0; A-Z as a-z)."""
    byte = np.arange(256, dtype=np.uint64)
    byte[65:91] += np.uint64(32)
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    value = mix64((byte + np.uint64(1)) * _BASE)
    value[space] = 0
    return value, space


_VALUE, _SPACE = _byte_table()


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the rows+1 word offsets."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[raw]
    start = ~space
    start[1:] &= space[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    start[edges] = ~space[edges]
    starts = np.flatnonzero(start)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    # a document's leading white space ends the word before it: it weighs 0
    lengths = np.diff(starts, append=n)
    place = np.arange(starts[0], n, dtype=np.int64) - np.repeat(starts, lengths)
    power = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    sums = np.add.reduceat(_VALUE[raw[starts[0]:]] * power[place], starts - starts[0])
    return mix64(sums), np.searchsorted(starts, offsets)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row end to end, and the rows+1
    offsets into them."""
    h, at = word_hashes(raw, offsets)
    rows = len(offsets) - 1
    count = np.diff(at)
    keys = mix64(np.arange(1, words + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    total = len(h) - words + 1
    if total > 0:
        mixed = h[:total] * keys[0]
        for k in range(1, words):
            mixed += h[k:k + total] * keys[k]
        mixed = mix64(mixed)
    out, sizes = [], np.zeros(rows, np.int64)
    for r in range(rows):
        n = count[r]
        if n >= words:
            own = mixed[at[r]:at[r + 1] - words + 1]
            own = np.sort(own)
            if len(own) > 1:
                own = own[np.append(True, own[1:] != own[:-1])]
        elif n:
            part = h[at[r]:at[r + 1]]
            own = mix64(np.array([(part * keys[:n]).sum() + np.uint64(n)], np.uint64))
        else:
            continue
        out.append(own)
        sizes[r] = len(own)
    flat = np.concatenate(out) if out else np.zeros(0, np.uint64)
    return flat, np.append(0, np.cumsum(sizes))
