"""Longest common extensions from a difference cover.

Of the positions of a sequence only those whose remainder modulo ``PERIOD`` is in a
difference cover are sorted as suffixes. Any two positions reach such a pair after the
same few steps: up to there words are compared, from there on the answer is a minimum
over the neighbours' common prefixes, kept for ranges of every power of two.
"""

from __future__ import annotations

import numpy as np

# A perfect difference set: every remainder but 0 is the difference of just one pair.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: By the distance of two positions: the remainder at which both are in the cover.
_MEET = np.array(
    [next(a for a in COVER if (a + d) % PERIOD in COVER) for d in range(PERIOD)], np.int64
)


def steps_to_cover(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The number of steps after which both positions are in the cover, below ``PERIOD``."""
    return (_MEET[(j - i) % PERIOD] - i) % PERIOD


def compare(words: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Equal words from ``i`` and ``j`` on, ``most`` at the most; few steps for all at once."""
    equal = np.zeros(len(i), np.int64)
    left = np.flatnonzero(most > 0)
    step = 0
    while len(left):
        left = left[words[i[left] + step] == words[j[left] + step]]
        step += 1
        equal[left] = step
        left = left[most[left] > step]
    return equal


class Extensions:
    """Answers how many words from two positions on are equal.

    ``words`` are numbers; every sequence in it ends with a number of its own, so no
    answer reaches beyond. ``inside`` marks the positions that may be asked for, whole
    sequences with their ends. Memory is a few numbers a position, and the ranges of
    the sampled positions.
    """

    def __init__(self, words: np.ndarray, inside: np.ndarray) -> None:
        self.words = words
        at = np.flatnonzero(inside & _IN_COVER[np.arange(len(words)) % PERIOD])
        self.index = np.full(len(words) + 1, -1, np.int64)
        self.index[at] = np.arange(len(at))
        self.at = at
        self._sort()
        self._ranges()

    def _split(self, tied: np.ndarray, following: np.ndarray) -> np.ndarray:
        """Order tied suffixes by what follows; those still tied are returned.

        A rank is the number of suffixes in smaller groups, so the ranks of other
        groups stay.
        """
        order = np.lexsort((following, self.rank[tied]))
        tied, following = tied[order], following[order]
        old = self.rank[tied]
        new_old = np.concatenate([[True], old[1:] != old[:-1]])
        new = new_old | np.concatenate([[True], following[1:] != following[:-1]])
        place = np.arange(len(tied))
        group = np.maximum.accumulate(np.where(new_old, place, 0))
        start = np.maximum.accumulate(np.where(new, place, 0))
        self.rank[tied] = old + start - group
        alone = new & np.concatenate([new[1:], [True]])
        return tied[~alone]

    def _sort(self) -> None:
        """Ranks of the sampled suffixes: word by word up to a period, then by doubling."""
        self.rank = np.zeros(len(self.at), np.int64)
        tied = np.arange(len(self.at))
        for step in range(PERIOD):
            if not len(tied):
                break
            tied = self._split(tied, self.words[self.at[tied] + step])
        self.levels = []
        reach = PERIOD
        while len(tied):
            self.levels.append(self.rank.copy())
            # Tied suffixes share ``reach`` words and no end, and what follows is sampled.
            tied = self._split(tied, self.rank[self.index[self.at[tied] + reach]])
            reach *= 2
        self.levels.append(self.rank)

    def _ranges(self) -> None:
        """Common prefixes of neighbours in the order, and their minima over ranges."""
        order = np.empty(len(self.at), np.int64)
        order[self.rank] = np.arange(len(self.at))
        i, j = self.at[order[:-1]].copy(), self.at[order[1:]].copy()
        shared = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 2, -1, -1):
            rank, reach = self.levels[k], PERIOD << k
            same = rank[self.index[i]] == rank[self.index[j]]
            shared[same] += reach
            i[same] += reach
            j[same] += reach
        shared += compare(self.words, i, j, np.full(len(i), PERIOD))
        del self.levels
        # Entry r is the common prefix of ranks r and r + 1.
        self.minima = [shared]
        while 2 << len(self.minima) - 1 <= len(shared):
            last, half = self.minima[-1], 1 << len(self.minima) - 1
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from sampled positions ``i`` and ``j`` on; they must differ."""
        a, b = self.rank[self.index[i]], self.rank[self.index[j]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(i), np.int64)
        for k in np.unique(level):
            some = level == k
            minima = self.minima[k]
            out[some] = np.minimum(minima[low[some]], minima[high[some] - (1 << int(k))])
        return out
