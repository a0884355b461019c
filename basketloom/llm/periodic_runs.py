"""Periodic runs: stretches of words that repeat themselves, all of them, with their periods.

A stretch of period p and at least twice its length holds two neighbours of the grid
0, p, 2p, ...: how far the words around such a pair agree, to either side, gives the
stretch. All grids of a text together have n log n pairs, most of which differ in the
first word; the rest are extended by a few comparisons, and the few that agree up to the
next places of a difference cover by common extensions of its suffixes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketloom.llm.common import chunks, utf8
from basketloom.llm.lce import PERIOD, Extensions, compare, steps_to_cover

MIN_WORDS = 12

#: Grid pairs that are looked at together.
PAIRS = 1 << 20

SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
)


class _Joined:
    """The words of several texts as numbers in one sequence, a number of its own around each."""

    def __init__(self, texts: list[list[bytes]]) -> None:
        flat = pa.array([w for words in texts for w in words], pa.binary())
        codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.size = np.array([len(words) for words in texts], np.int64)
        #: Where each text begins; before and behind it stands an end.
        self.begin = np.cumsum(self.size + 1) - self.size
        ends = np.concatenate([[0], self.begin + self.size])
        # Behind the last end as many others as a comparison may read.
        self.words = np.empty(int(ends[-1]) + 1 + PERIOD, np.int64)
        is_word = np.ones(len(self.words), bool)
        is_word[ends] = False
        is_word[ends[-1] :] = False
        self.words[is_word] = codes
        self.words[~is_word] = len(codes) + np.arange(int((~is_word).sum()))

    def mask(self, texts: np.ndarray) -> np.ndarray:
        """Positions of some texts and the ends on either side."""
        edge = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(edge, self.begin[texts] - 1, 1)
        np.add.at(edge, self.begin[texts] + self.size[texts] + 1, -1)
        return np.cumsum(edge[:-1]) > 0


def _grids(
    joined: _Joined, texts: np.ndarray, min_words: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of equal words a period apart, of all grids of some texts: text, place, period.

    A run of period p has max(min_words, 2p) words, so the places with a partner in
    it are that less p; grids are as wide.
    """
    size = joined.size[texts]
    most = np.where(size >= min_words, size // 2, 0)
    text = np.repeat(texts, most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    width = np.maximum(min_words - period, period)
    count = -(-(joined.size[text] - period) // width)
    slab = (np.cumsum(count) - count) // PAIRS
    cuts = [0, *(np.flatnonzero(np.diff(slab)) + 1).tolist(), len(text)]
    words = joined.words
    for a, b in zip(cuts, cuts[1:]):
        n = count[a:b]
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        p = np.repeat(period[a:b], n)
        place = np.repeat(joined.begin[text[a:b]], n) + k * np.repeat(width[a:b], n)
        same = np.flatnonzero(words[place] == words[place + p])
        yield np.repeat(text[a:b], n)[same], place[same], p[same]


def find_runs(
    texts: list[list[bytes]], min_words: int = MIN_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of some texts: text, start, length and smallest period, in this order.

    A run is a stretch of ``min_words`` words and twice its smallest period at least
    that neither neighbour prolongs.
    """
    joined = _Joined(texts)
    words, mirrored, last = joined.words, joined.words[::-1].copy(), len(joined.words) - 1
    found, unsure = [np.zeros((4, 0), np.int64)], [np.zeros(0, np.int64)]

    def near(text: np.ndarray, i: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, ...]:
        """Extensions to either side up to where both places are in the cover, and if they go on."""
        ahead, behind = steps_to_cover(i, i + p), steps_to_cover(last - i + 1, last - i - p + 1)
        right = compare(words, i, i + p, ahead)
        left = compare(mirrored, last - i + 1, last - i - p + 1, behind)
        return right, left, right == ahead, left == behind

    def keep(text: np.ndarray, i: np.ndarray, p: np.ndarray, right: np.ndarray, left: np.ndarray) -> None:
        run = right + left + p >= np.maximum(min_words, 2 * p)
        found.append(_smallest(np.stack([text, i - left, right + left + p, p])[:, run]))

    # First what a few comparisons settle, and the texts with more to do.
    for text, i, p in _grids(joined, np.arange(len(texts)), min_words):
        right, left, on_right, on_left = near(text, i, p)
        open_ = on_right | on_left
        unsure.append(np.unique(text[open_]))
        keep(*(x[~open_] for x in (text, i, p, right, left)))
    asked = np.unique(np.concatenate(unsure))
    if len(asked):
        inside = joined.mask(asked)
        forward, backward = Extensions(words, inside), Extensions(mirrored, inside[::-1])
        for text, i, p in _grids(joined, asked, min_words):
            right, left, on_right, on_left = near(text, i, p)
            at = i[on_right] + right[on_right]
            right[on_right] += forward.between(at, at + p[on_right])
            at = last - i[on_left] + 1 + left[on_left]
            left[on_left] += backward.between(at, at - p[on_left])
            keep(text, i, p, right, left)
    text, start, length, period = _smallest(np.concatenate(found, axis=1))
    return text, start - joined.begin[text], length, period


def _smallest(rows: np.ndarray) -> np.ndarray:
    """Of equal stretches the one of the smallest period; by text, start and period.

    A stretch of period p and 2p words or more whose smallest period is less has that
    one as a divisor of p, so it is the same stretch.
    """
    rows = rows[:, np.lexsort((rows[3], rows[2], rows[1], rows[0]))]
    first = np.ones(rows.shape[1], bool)
    first[1:] = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    rows = rows[:, first]
    return rows[:, np.lexsort((rows[3], rows[1], rows[0]))]


def planted_words(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, in one of ten documents made periodic from some place on.

    With h the CRC-32 of the decimal id and g = h div 10, where 10 divides h the words
    from a = g mod n on repeat with period 1 + (n - a) div (3 + g mod 8). A document
    without id stays as it is.
    """
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(b"%d" % doc_id)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    repeats = -(-(n - a) // p)
    return words[:a] + (words[a : a + p] * repeats)[: n - a]


def _digests(texts: list[list[bytes]], min_words: int) -> list[tuple]:
    """A row of :func:`run_digests` for each text, without its id."""
    text, start, length, period = find_runs(texts, min_words)
    cuts = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
    rows = []
    for k, words in enumerate(texts):
        s, n, p = (x[cuts[k] : cuts[k + 1]].tolist() for x in (start, length, period))
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s, n, p))
        longest = None, None, None, None
        if s:
            b, a, c = min((-b, a, c) for a, b, c in zip(s, n, p))
            longest = a, -b, c, 1000 * -b // c
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, np.add(s, p), 1)
            np.add.at(edge, np.add(s, n), -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
        rows.append(
            (len(s), *longest, hashlib.sha256(lines.encode()).hexdigest(),
             hashlib.sha256(b" ".join(words)).hexdigest())
        )
    return rows


def run_digests(docs: DataFrame, min_words: int = MIN_WORDS, planted: bool = False) -> DataFrame:
    """``DF[doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256]``.

    One row per row of ``docs``: the number of runs of its whole text, the longest one
    (ties: smallest start, then period; nulls without a run), digests of all runs and of
    the text without their repetitions. A word of a run after its first period is
    dropped, the others are joined by single blanks. ``planted`` reads the texts as
    :func:`planted_words` changes them.

    Words are what ASCII white space leaves. A null, empty or blank text has no words,
    no run and the digests of nothing. Repeated rows give repeated rows, a null id stays
    null, an empty table gives no rows, other columns are not read. Narrow: nothing is
    shuffled. A long text is alone in its batch; its memory grows with its words, the
    pairs of its grids are made a slab at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            ids = batch.column("doc_id").cast(pa.int64())
            texts = [t.split() for t in utf8(batch)]
            if planted:
                texts = [planted_words(w, i) for w, i in zip(texts, ids.to_pylist())]
            columns = list(zip(*_digests(texts, min_words)))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, pa.int64()) for c in columns[:5]),
                 *(pa.array(c, pa.string()) for c in columns[5:])],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                 "runs_sha256", "collapsed_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def collapse_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repetitions of every run taken out of ``text``, all other columns kept.

    A text with a run becomes its kept words joined by single blanks; one without stays
    as it is, null too.
    """
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = [t.split() for t in utf8(batch)]
            text, start, length, period = find_runs(texts, min_words)
            out = batch.column(place).to_pylist()
            for k in np.unique(text).tolist():
                some = text == k
                edge = np.zeros(len(texts[k]) + 1, np.int64)
                np.add.at(edge, (start + period)[some], 1)
                np.add.at(edge, (start + length)[some], -1)
                kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
                out[k] = b" ".join([texts[k][i] for i in kept]).decode()
            columns = batch.columns
            columns[place] = pa.array(out, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
