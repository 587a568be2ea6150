"""Words and word n-grams of many texts at once, as 64-bit hashes in numpy.

Texts lie one after the other in one byte buffer; words never cross texts. ASCII capitals are lower-cased. Different
words or n-grams share a hash with probability 2**-64.
"""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Words between white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

# Words of letters, digits and everything beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
PLAIN = np.zeros(256, bool)
PLAIN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


ODD = np.uint64(0x9E3779B97F4A7C15)
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * ODD)
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        grown = np.full(max(n, 4096), ODD, np.uint64)
        grown[0] = 1
        _POWERS = np.cumprod(grown, dtype=np.uint64)
    return _POWERS


def word_places(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes belong to words, where words start, and their lengths."""
    inside = table[data]
    begins, ends = np.empty_like(inside), np.empty_like(inside)
    if len(data):
        begins[0], begins[1:] = True, ~inside[:-1]
        ends[-1], ends[:-1] = True, ~inside[1:]
        filled = offsets[1:] > offsets[:-1]
        begins[offsets[:-1][filled]] = True
        ends[offsets[1:][filled] - 1] = True
    starts = np.flatnonzero(inside & begins)
    return inside, starts, np.flatnonzero(inside & ends) + 1 - starts


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for every text the index of its first word (one more at the end).

    ``fold``: capitals count as small letters.
    """
    if fold:
        data = LOWER[data]
    inside, starts, lengths = word_places(data, offsets, table)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    packed = np.cumsum(lengths) - lengths
    within = np.arange(packed[-1] + lengths[-1]) - np.repeat(packed, lengths)
    values = BYTE[data[inside]] * _powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(values, packed) + lengths.astype(np.uint64)), first


def grams(words: np.ndarray, n: int, factor: np.uint64 = ODD) -> np.ndarray:
    """Hashes of all runs of n words, also of those that cross texts; another odd factor gives an independent hash."""
    size = max(0, len(words) - n + 1)
    h = np.zeros(size, np.uint64)
    for i in range(n):
        h = h * factor + words[i : i + size]
    return mix(h + np.uint64(n))


def within_text(first: np.ndarray, n: int, size: int) -> np.ndarray:
    """For each run of n words whether it stays inside one text."""
    left = np.repeat(first[1:], np.diff(first))[:size]
    return np.arange(size) + n <= left


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """The least of every w values in a row, by doubling."""
    out, width = h, 1
    while width < w:
        step = min(width, w - width)
        out = np.minimum(out[: len(out) - step], out[step:])
        width += step
    return out
