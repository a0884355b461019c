"""Chains of runs of seeds that two texts share, and their alignment word by word."""

from __future__ import annotations

from collections import Counter

import numpy as np

#: Words of a seed, and the cost of each word between two seeds of a chain, in either text.
SEED_WORDS = 5
GAP_COST = 0.04
#: Words an end is extended by at most, words that may differ at once, and that must follow.
REACH = 64
SLIP = 3
FOLLOW = 3
#: Diagonals beside the first that gaps, and ends, are aligned on.
BAND = 64
ENDS = 10


class PrefixMaximum:
    """A Fenwick tree of the best (score, number) among places up to a given one."""

    def __init__(self, n: int) -> None:
        self.best: list[tuple[float, int]] = [(0.0, -1)] * (n + 1)

    def put(self, place: int, item: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            if item > self.best[place]:
                self.best[place] = item
            place += place & -place

    def upto(self, place: int) -> tuple[float, int]:
        """The best of the places before ``place``."""
        found = (0.0, -1)
        while place > 0:
            if self.best[place] > found:
                found = self.best[place]
            place -= place & -place
        return found


def chains(places: np.ndarray, others: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
    """Numbers of the runs of each chain, best chains first; a run is in one chain only.

    A run is ``sizes`` equal words from ``places`` in one text, ascending, and from
    ``others`` in the other. In a chain the last seed of a run is before the next run
    in both texts. A run counts its words, less the gap cost; as that cost is linear,
    the best predecessor is a prefix maximum.
    """
    n = len(places)
    if n == 1:
        return [[0]]
    slots = np.unique(np.concatenate([others, others + sizes - SEED_WORDS]), return_inverse=True)[1]
    tree = PrefixMaximum(int(slots.max()) + 1)
    first, last = slots[:n].tolist(), slots[n:].tolist()
    start = (GAP_COST * (places + others)).tolist()
    end = (GAP_COST * (places + others + 2 * sizes)).tolist()
    at, until, words = places.tolist(), (places + sizes - SEED_WORDS).tolist(), sizes.tolist()
    score, back = [0.0] * n, [-1] * n
    done = sorted(range(n), key=until.__getitem__)
    ended = 0
    for i in range(n):
        while until[done[ended]] < at[i]:
            j = done[ended]
            tree.put(last[j], (score[j] + end[j], j))
            ended += 1
        best, j = tree.upto(first[i])
        gain = best - start[i]
        score[i] = words[i] + max(0.0, gain) if j >= 0 else float(words[i])
        back[i] = j if j >= 0 and gain > 0 else -1
    out, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


def edit_distance(a: list[bytes], b: list[bytes], band: int = BAND) -> int:
    """Words to replace, insert or delete.

    Exact up to ``band``. Beyond, alignments that leave the band are not seen, so the
    distance may come out larger, but never above the words of the longer text.
    """
    low = 0
    while low < len(a) and low < len(b) and a[low] == b[low]:
        low += 1
    a, b = a[low:], b[low:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    far = max(len(a), len(b))
    if not a or not b or abs(len(a) - len(b)) > band:
        return far
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        first, stop = max(1, i - band), min(len(b), i + band)
        corner = row[first - 1]
        left = row[first - 1] = i if first == 1 else far
        for j in range(first, stop + 1):
            above = row[j] if j < i + band else far
            left = min(above + 1, left + 1, corner + (x != b[j - 1]))
            corner, row[j] = row[j], left
    return min(row[-1], far)


def stretch(a: list[bytes], b: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For the first words of ``a``, by their number: the least edits to first words of
    ``b``, and the number of those; both within ``ENDS`` diagonals."""
    row = list(range(min(len(b), ENDS) + 1)) + [len(a) + len(b)] * (len(b) - min(len(b), ENDS))
    edits, where = [0], [0]
    for i, x in enumerate(a, 1):
        first, stop = max(1, i - ENDS), min(len(b), i + ENDS)
        if first > len(b):
            break
        corner = row[first - 1]
        left = row[first - 1] = i if first == 1 else len(a) + len(b)
        best, at = (left, 0) if first == 1 else (len(a) + len(b), 0)
        for j in range(first, stop + 1):
            above = row[j]
            left = min(above + 1, left + 1, corner + (x != b[j - 1]))
            corner, row[j] = above, left
            if left < best or (left == best and x == b[j - 1]):
                best, at = left, j
        edits.append(best)
        where.append(at)
    return np.array(edits), np.array(where)


def extension(a: list[bytes], b: list[bytes]) -> tuple[int, int, int]:
    """Words of both texts, from their start, that go on alike, and the edits among them."""
    i = j = edits = 0
    limit = min(len(a), len(b))
    while True:
        while i < len(a) and j < len(b) and a[i] == b[j]:
            i, j = i + 1, j + 1
        step = None
        for size in range(1, SLIP + 1):
            for x, y in [(size, size), *((size, y) for y in range(size)), *((x, size) for x in range(size))]:
                next_a = a[i + x : i + x + FOLLOW]
                if len(next_a) == FOLLOW and next_a == b[j + y : j + y + FOLLOW]:
                    step = (x, y)
                    break
            if step:
                break
        if step is None or i >= limit + SLIP:
            return i, j, edits
        i, j, edits = i + step[0], j + step[1], edits + max(step)


def _ends(a: list[bytes], b: list[bytes], edits: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether a stretch may end there: with equal words, after as many alike as edits.

    So a passage is not made long enough by different words around it.
    """
    equal = [True, *(j > 0 and a[i] == b[j - 1] for i, j in enumerate(other[1:].tolist()))]
    return np.array(equal) & (2 * edits <= np.arange(len(edits)))


def passages(
    a: list[bytes], b: list[bytes], runs: list[tuple[int, int, int]], min_words: int, similarity: float
) -> list[tuple[int, int, int, int, float]]:
    """Alike passages along a chain: (start, end, other start, other end, similarity) in words.

    Gaps between runs are aligned, both ends extended. Where the whole is not alike
    enough it is cut at its worst gap and both parts are judged. A chain that has no
    passage so is aligned with all words in reach of its ends.
    """
    blocks: list[list[int]] = []  # start, other start, end, other end, edits before
    for x, y, size in runs:
        if blocks:
            trim = max(0, blocks[-1][2] - x, blocks[-1][3] - y)
            if trim >= size:
                continue
            x0, y0 = x + trim, y + trim
            edits = edit_distance(a[blocks[-1][2] : x0], b[blocks[-1][3] : y0])
            if edits == 0:
                blocks[-1][2:4] = [x + size, y + size]
                continue
            blocks.append([x0, y0, x + size, y + size, edits])
        else:
            blocks.append([x, y, x + size, y + size, 0])
    first, last = blocks[0], blocks[-1]
    after = a[last[2] : last[2] + REACH], b[last[3] : last[3] + REACH]
    before = (
        a[max(0, first[0] - REACH) : first[0]][::-1], b[max(0, first[1] - REACH) : first[1]][::-1]
    )
    ahead, behind = extension(*after), extension(*before)

    def judge(low: int, high: int) -> list[tuple[int, int, int, int, float]]:
        start, other = blocks[low][:2]
        end, other_end = blocks[high][2:4]
        edits = sum(block[4] for block in blocks[low + 1 : high + 1])
        if low == 0:
            start, other, edits = start - behind[0], other - behind[1], edits + behind[2]
        if high == len(blocks) - 1:
            end, other_end, edits = end + ahead[0], other_end + ahead[1], edits + ahead[2]
        words = max(end - start, other_end - other)
        if min(end - start, other_end - other) < min_words:
            return []
        alike = 1 - edits / words
        if alike >= similarity:
            return [(start, end, other, other_end, alike)]
        if low == high:
            return []
        worst = max(range(low + 1, high + 1), key=lambda g: blocks[g][4])
        return judge(low, worst - 1) + judge(worst, high)

    found = judge(0, len(blocks) - 1)
    if found or len(a) < min_words or len(b) < min_words:
        return found
    alike = sum((Counter(a) & Counter(b)).values())
    if alike < similarity * min_words:
        return []
    # Both ends at once: as many words as the edits allow.
    (edits_f, other_f), (edits_b, other_b) = stretch(*after), stretch(*before)
    ends = _ends(*after, edits_f, other_f)[:, None] & _ends(*before, edits_b, other_b)
    own = (last[2] - first[0] + np.arange(len(edits_f)))[:, None] + np.arange(len(edits_b))
    other = (last[3] - first[1] + other_f)[:, None] + other_b
    edits = (edits_f + sum(block[4] for block in blocks[1:]))[:, None] + edits_b
    share = 1 - edits / np.maximum(own, other)
    good = ends & (np.minimum(own, other) >= min_words) & (share >= similarity)
    if not good.any():
        return []
    # Of the longest the most alike; of those the first.
    i, j = np.unravel_index(np.argmax(np.where(good, own + share, -1)), own.shape)
    return [(first[0] - int(j), last[2] + int(i), first[1] - int(other_b[j]),
             last[3] + int(other_f[i]), float(share[i, j]))]
