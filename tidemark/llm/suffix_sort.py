"""Suffix sorting of one block at a time, with ties resolved by the ranks of a difference-cover sample."""

from __future__ import annotations

import numpy as np

PERIOD = 8
# A difference cover modulo 8: every difference 0..7 occurs between two of its members.
COVER = (0, 1, 2, 4)
BLOCK = 1 << 19


def _shift_table() -> np.ndarray:
    """For residues (r, q) the least shift d with r + d and q + d both in the cover."""
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for r in range(PERIOD):
        for q in range(PERIOD):
            table[r, q] = next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER and (q + d) % PERIOD in COVER)
    return table


SHIFT = _shift_table()


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one big-endian number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(7, np.uint8)]).astype(np.uint64)
    two = (padded[:-1] << np.uint64(8)) | padded[1:]
    four = (two[:-2] << np.uint64(16)) | two[2:]
    return (four[:-4] << np.uint64(32)) | four[4:]


def cover_ranks(words: np.ndarray, length: int) -> np.ndarray:
    """Rank by at least ``length`` bytes of every suffix in the sample, -1 elsewhere; by doubling.

    A place and the one PERIOD further on are in the sample together, so each round only needs sample ranks.
    """
    n = len(words)
    place = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    rank = np.full(n + 1, -1, np.int64)
    rank[place] = np.unique(words[place], return_inverse=True)[1]
    reach = PERIOD
    while reach < length:
        after = rank[np.minimum(place + reach, n)]
        pair = rank[place] * (n + 2) + after + 1
        rank[place] = np.unique(pair, return_inverse=True)[1]
        reach *= 2
    return rank


def _resolve(places: np.ndarray, run: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Order of the places by (run, suffix), where suffixes of a run agree in their first PERIOD bytes.

    A suffix's place in its run is the number of smaller ones, counted residue by residue: two residues
    have a common shift into the sample, where ranks decide.
    """
    last, residue = len(ranks) - 1, places % PERIOD
    wide = np.int64(len(ranks) + 2)
    before = np.zeros(len(places), np.int64)
    members = [np.flatnonzero(residue == r) for r in range(PERIOD)]
    for r in range(PERIOD):
        if not len(members[r]):
            continue
        for q in range(PERIOD):
            if len(members[q]):
                d = SHIFT[r, q]
                own = run[members[r]] * wide + ranks[np.minimum(places[members[r]] + d, last)] + 1
                other = np.sort(run[members[q]] * wide + ranks[np.minimum(places[members[q]] + d, last)] + 1)
                before[members[r]] += np.searchsorted(other, own) - np.searchsorted(other, run[members[r]] * wide)
    return np.lexsort((before, run))


def sorted_blocks(text: np.ndarray, places: np.ndarray, length: int, block: int = BLOCK):
    """The places in the order of their suffixes (by at least ``length`` bytes), one bucket of suffixes at a time.

    Buckets are ranges of the first PERIOD bytes with about ``block`` places; equal heads stay in one bucket. Yields
    (places, equal), where equal tells whether a suffix agrees with the one before it in ``length`` bytes.
    """
    words = words_at(text)
    ranks = cover_ranks(words, length)
    heads = words[places]
    cuts = np.unique(np.sort(heads)[::block]) if len(heads) else heads
    bucket = np.searchsorted(cuts, heads, side="right")
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(1, len(cuts) + 2))
    for low, high in zip(edges[:-1], edges[1:]):
        own = places[order[low:high]]
        own = own[np.argsort(words[own], kind="stable")]
        head = words[own]
        new = np.concatenate([[True], head[1:] != head[:-1]]) if len(own) else np.zeros(0, bool)
        run = np.cumsum(new)
        tied = np.bincount(run)[run] > 1 if len(own) else new
        at = np.flatnonzero(tied)
        own[at] = own[at][_resolve(own[at], run[at], ranks)]
        equal = np.zeros(len(own), bool)
        if len(own) > 1:
            same = np.ones(len(own) - 1, bool)
            steps = [*range(0, length - 8, 8), max(length - 8, 0)]
            for step in steps:
                a, b = own[1:] + step, own[:-1] + step
                same &= words[np.minimum(a, len(words) - 1)] == words[np.minimum(b, len(words) - 1)]
            equal[1:] = same
        yield own, equal
