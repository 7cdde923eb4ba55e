"""Words of whole texts as 64-bit hashes, found and hashed in numpy over UTF-8 bytes.

A word is a maximal run of ASCII digits, ASCII letters (A-Z lower-cased) and non-ASCII
characters. Every byte of a non-ASCII character is at least 0x80, so bytes decide.
"""

from __future__ import annotations

import numpy as np

_BYTE = np.arange(256)
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
IN_WORD = ((LOWER >= 48) & (LOWER <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (LOWER >= 128)
_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)[LOWER]
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []
SEGMENT = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, SEGMENT + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        made = []
        for base in (_BASE, inverse):
            step = np.full(size, np.uint64(base))
            step[0] = 1
            made.append(np.cumprod(step))
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word; a word never crosses a row."""
    inside = IN_WORD[raw]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(raw)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words of each row)."""
    starts, ends = word_bounds(raw, offsets)
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        # Whole words of about SEGMENT bytes; a longer word stands alone.
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + SEGMENT, "right")))
        a, b = starts[lo], ends[hi - 1]
        power, inverse = _powers(b - a)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_CODES[raw[a:b]] * power[: b - a], out=total[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = (total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)
        lo = hi
    return mix(out), np.diff(np.searchsorted(starts, offsets))


def shingles(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of `width` words, row of each); a row of fewer, but not none, has one of all its words."""
    first = np.concatenate(([0], np.cumsum(counts)))
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), n)
    at = np.repeat(first[:-1], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    size = np.minimum(counts[row], width)
    h = np.zeros(len(at), np.uint64)
    for j in range(width):
        has = size > j
        h[has] = mix(h[has] * np.uint64(0x9E3779B97F4A7C15) + words[at[has] + j] + np.uint64(j + 1))
    return h, row
