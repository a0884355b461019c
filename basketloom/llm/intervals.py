"""Long repeats in a block of segments, by intervals of a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np



def sorted_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of all suffixes in the order of their first ``depth`` symbols or more.

    Also which of them differ from the one before within the first ``packed``
    symbols, and that number. ``text`` has symbols 0 to 256. The first key packs as
    many symbols as fit; each further round joins the ranks of two or three.
    """
    n = len(text)
    symbols, dense = np.unique(text, return_inverse=True)
    bits = max(1, int(len(symbols) - 1).bit_length())
    known = packed = min(62 // bits, depth)
    key = np.zeros(n, np.int64)
    for i in range(packed):
        key[: max(0, n - i)] |= dense[i:] << (bits * (packed - 1 - i))
    order = np.argsort(key)
    ordered = key[order]
    apart = np.ones(n, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=apart[1:])
    fresh = apart
    width = max(1, int(n).bit_length())
    parts = 3 if 3 * width < 63 else 2
    while known < depth and not fresh.all():
        rank = np.zeros(n + known * (parts - 1), np.int64)  # beyond the end: the smallest
        rank[order] = np.cumsum(fresh)
        # Only suffixes that are equal to a neighbour so far are sorted again.
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        slots = np.flatnonzero(tied)
        places = order[slots]
        key = rank[places]
        for part in range(1, parts):
            key = key << width | rank[places + part * known]
        by = np.argsort(key)
        order[slots] = places[by]
        key = key[by]
        # Ranks of different runs of slots differ, so only equal keys stay together.
        fresh = np.ones(n, bool)
        fresh[slots[1:]] = key[1:] != key[:-1]
        known *= parts
    return order, apart, packed


def common_prefixes(
    text: np.ndarray, order: np.ndarray, apart: np.ndarray, packed: int, depth: int
) -> np.ndarray:
    """For each suffix in ``order``, whether it shares less than ``depth`` symbols with the one before.

    Breadth-first backward extension, from the intervals of all strings of
    ``packed`` symbols on, which ``apart`` delimits. An interval is extended by
    every symbol that precedes one of its suffixes; where the new interval ends,
    the common prefix has the new string's length less one, unless a shorter one
    is known there already, and then the interval is dropped. So common prefixes
    are found by increasing value, and the search stops at ``depth``. Symbol 0
    separates segments and is not extended by.
    """
    n = len(text)
    before = text[order - 1]  # the transform; the first suffix is preceded by the last symbol
    counts = np.bincount(text, minlength=257)
    steps = np.empty(n, np.int32)  # where the suffix longer by one is
    steps[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)
    leads = np.repeat(np.arange(257, dtype=np.int16), counts)
    short = np.append(apart, True)
    owner = np.full(n + 2, -1, np.int32)
    starts = np.flatnonzero(apart)
    ends = np.append(starts[1:], n) - 1
    for _ in range(packed, depth):
        if not len(starts):
            break
        sizes = ends - starts + 1
        stops = np.cumsum(sizes)
        mine = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
        rows = np.arange(stops[-1]) - np.repeat(stops - sizes - starts, sizes)
        real = before[rows] != 0
        mine = mine[real]
        new = steps[rows[real]]
        owner[new + 1] = mine
        symbol = leads[new]
        last = owner[new + 2] != mine
        last |= leads[np.minimum(new + 1, n - 1)] != symbol
        head = owner[new] != mine
        head |= leads[np.maximum(new - 1, 0)] != symbol
        new_ends = np.sort(new[last])
        new_starts = np.sort(new[head])
        owner[new + 1] = -1
        unknown = ~short[new_ends + 1]
        short[new_ends[unknown] + 1] = True
        starts, ends = new_starts[unknown], new_ends[unknown]
    return short[:n]


def repeated_windows(
    segments: list[bytes], copies: list[int], window: int
) -> list[np.ndarray]:
    """For each segment, which of its windows are in another place too.

    ``copies`` says how often a segment itself is there.
    """
    sizes = np.array([len(s) for s in segments])
    raw = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    text = raw.astype(np.int16) + 1
    text[ends] = 0
    order, apart, packed = sorted_suffixes(text, window)
    short = common_prefixes(text, order, apart, packed, window)
    alike = ~short
    alike[:-1] |= ~short[1:]
    repeated = np.empty(len(text), bool)
    repeated[order] = alike
    out = []
    for end, size, many in zip(ends, sizes, copies):
        n = max(0, size - window + 1)
        start = end - size
        out.append(repeated[start : start + n] | (many > 1))
    return out
