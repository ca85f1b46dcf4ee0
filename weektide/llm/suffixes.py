"""Burrows-Wheeler transform and common prefixes of many strings, column by column."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, ends: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins of all suffixes of the strings in sorted order, and the common prefix of
    each with the one before, counted up to ``limit``.

    ``text`` holds the symbols (below 65 535) of the strings one after another and
    ``ends`` where each ends.  Round
    ``j`` inserts the suffix of length ``j`` of every string that has one.  The
    transform lists, in the order of the suffixes there are, the symbol before each.
    Its entries with a symbol, sorted by it (equal ones as they stand), are just the
    suffixes there will be after the round, in order; those of strings inserted last
    are the new ones.  Two suffixes with the same first symbol share one symbol more
    than what follows it, and that is the least common prefix on the way from one
    entry of the transform to the other.
    """
    n = len(ends)
    begins = np.concatenate([[0], ends[:-1]])
    place = ends.copy()  # begin of the suffix at each rank
    common = np.zeros(n, np.uint8)
    # The symbol before each suffix, plus one; 0 at a string's begin.
    text = np.append(text.astype(np.uint16) + np.uint16(1), np.uint16(0))
    before = np.where(ends > begins, text[ends - 1], np.uint16(0))
    latest = np.ones(n, bool)
    owner_begin = begins.copy()  # begin of the string of each suffix inserted last, by rank
    while True:
        order = np.argsort(before, kind="stable")
        order = order[np.searchsorted(before[order], 1) :]
        new = latest[order]
        if not new.any():
            return place[n:], common[n:]
        first = np.zeros(len(place), np.int64)
        first[latest] = owner_begin
        added, begin = order[new], first[order[new]]
        # Common prefixes that change: of the new suffixes and of those after them.
        asked = np.flatnonzero(new | np.concatenate([[False], new[:-1]]))
        asked = asked[asked > 0]
        asked = asked[before[order[asked]] == before[order[asked - 1]]]
        share = np.zeros(len(order), np.uint8)
        if len(asked):
            turn = asked[np.argsort(-order[asked])]
            bounds = np.empty(2 * len(turn), np.int64)
            bounds[0::2], bounds[1::2] = order[turn - 1] + 1, order[turn] + 1
            padded = np.append(common, np.uint8(0))
            least = np.minimum.reduceat(padded, bounds)[0::2]
            share[turn] = np.minimum(least.astype(np.int64) + 1, limit)
        at = place[added] - 1
        symbols = np.where(at > begin, text[at - 1], np.uint16(0))
        size = n + len(order)
        merged, grown, symbol = np.empty(size, np.int64), np.empty(size, np.uint8), np.empty(size, np.uint16)
        merged[:n], grown[:n], symbol[:n] = place[:n], common[:n], before[:n]
        old = ~new
        merged[n:][new], merged[n:][old] = at, place[n:]
        symbol[n:][new], symbol[n:][old] = symbols, before[n:]
        grown[n:][old] = common[n:]
        changed = new.copy()
        changed[1:] |= new[:-1]
        grown[n:][changed] = share[changed]
        latest = np.zeros(size, bool)
        latest[n:] = new
        owner_begin = begin
        place, common, before = merged, grown, symbol
