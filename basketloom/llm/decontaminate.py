"""Benchmark decontamination by the q-gram lemma.

Each benchmark item is cut into overlapping windows. A text that holds a window
with at most ``k`` edits shares a number of its q-grams with it, on diagonals that
differ by ``k`` at most. So shared q-grams are counted in overlapping diagonal
bands, and the bands that reach the bound are verified by banded alignment.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.common import chunks, filtered, utf8, written

Q = 12
WINDOW = 100
#: Twice the edits of a window: any quote of ``WINDOW`` bytes is a window but for half a step.
STEP = 12
#: Edits allowed in a window, as a share of its bytes.
EDITS = 0.06
#: Diagonals by which bands start after each other; a band has twice as many.
BAND = 8
#: Bytes of benchmark text an executor holds; larger benchmarks take several passes.
BLOCK_BYTES = 1 << 19
#: Bytes of text searched at a time, and bands aligned at a time.
TEXT_BYTES = 1 << 20
ALIGNED = 2048
#: Pairs of equal q-grams of a text and of windows that are counted at a time.
EXPANDED = 1 << 20
# Added to places so that none is negative; a multiple of BAND.
_OFFSET = (WINDOW // BAND + 1) * BAND

MATCHES = (
    "doc_id bigint, item_id bigint, windows int, edits int,"
    " spans array<struct<start: bigint, end: bigint>>"
)

# Upper case ASCII as lower case, white space as a space: one byte for one byte.
_FOLD = bytes(
    32 if b in b"\t\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


def grams(raw: bytes) -> np.ndarray:
    """Codes of all q-grams of ``raw``, by their place."""
    n = len(raw) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    low = np.ndarray(n, "<u8", raw, 0, (1,)) * np.uint64(0x9E3779B97F4A7C15)
    high = np.ndarray(n, "<u4", raw, 8, (1,)) * np.uint64(0xC2B2AE3D27D4EB4F)
    low ^= low >> np.uint64(29)
    low += high
    low *= np.uint64(0xBF58476D1CE4E5B9)
    return low


@dataclass(frozen=True)
class Window:
    item_id: int
    text: bytes
    edits: int
    shared: int  # q-grams that at most `edits` edits leave


def windows(items: list[tuple[int, str]]) -> list[Window]:
    """The different windows of each benchmark item; items shorter than a q-gram have none."""
    out = []
    for item_id, text in items:
        raw = (text or "").encode().translate(_FOLD).strip()
        last = max(0, len(raw) - WINDOW)
        parts = [raw[start : start + WINDOW] for start in sorted({*range(0, last, STEP), last})]
        for part in dict.fromkeys(parts):
            if len(part) < Q:
                continue
            edits = min(int(EDITS * len(part)), (len(part) - Q) // Q, BAND - 1)
            out.append(Window(item_id, part, edits, len(part) - Q + 1 - edits * Q))
    return out


class Searcher:
    """Finds windows in texts."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.windows = windows(items)
        codes = [grams(w.text) for w in self.windows]
        every = np.concatenate([np.zeros(0, np.uint64), *codes])
        order = np.argsort(every, kind="stable")
        self.codes = every[order]
        self.window = np.repeat(np.arange(len(codes), dtype=np.int32), [len(c) for c in codes])[order]
        self.place = np.concatenate(
            [np.zeros(0, np.int8), *(np.arange(len(c), dtype=np.int8) for c in codes)]
        )[order]
        bits = min(24, max(18, int(len(every) * 64).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.present = np.zeros(1 << bits, bool)
        self.present[every >> self.shift] = True
        self.shared = np.array([w.shared for w in self.windows], np.int64)

    def bands(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Windows and bands that share enough q-grams; band b holds starts from b * BAND on."""
        codes = grams(raw)
        at = np.flatnonzero(self.present[codes >> self.shift])
        found = codes[at]
        left = np.searchsorted(self.codes, found, "left")
        times = np.searchsorted(self.codes, found, "right") - left
        ends = np.cumsum(times)
        if not len(ends) or not ends[-1]:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # Repeated characters meet all places of an item's: so many pairs at a time.
        cuts = np.unique(np.searchsorted(ends, np.arange(0, int(ends[-1]), EXPANDED), "left"))
        counted = [
            self._counted(at[a:b], left[a:b], times[a:b])
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)])
        ]
        keys = np.concatenate([k for k, _ in counted])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        counts = np.add.reduceat(np.concatenate([c for _, c in counted])[order], first)
        keys = keys[first]
        keys = keys[counts >= self.shared[keys >> 36]]
        return keys >> 36, (keys & ((1 << 36) - 1)) - _OFFSET // BAND

    def _counted(
        self, at: np.ndarray, left: np.ndarray, times: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Windows and bands, as one key, and their q-grams at some places of a text."""
        total = int(times.sum())
        ends = np.cumsum(times)
        nth = np.arange(total) - np.repeat(ends - times, times) + np.repeat(left, times)
        start = np.repeat(at, times) - self.place[nth] + _OFFSET
        keys = (self.window[nth].astype(np.int64) << 36) + start // BAND
        return np.unique(np.concatenate([keys, keys - 1]), return_counts=True)

    def search(self, raw: bytes) -> Iterator[tuple[Window, int, int, int]]:
        """(window, start, end, edits) of the best alignment in each band within the budget."""
        which, band = self.bands(raw)
        lengths = np.array([len(w.text) for w in self.windows], np.int64)
        for length in np.unique(lengths[which]):
            same = np.flatnonzero(lengths[which] == length)
            for part in range(0, len(same), ALIGNED):
                some = same[part : part + ALIGNED]
                chosen = [self.windows[w] for w in which[some]]
                starts = band[some] * BAND - BAND
                text = np.frombuffer(raw, np.uint8)
                places = starts[:, None] + np.arange(int(length) + 4 * BAND)
                inside = (places >= 0) & (places < len(raw))
                region = np.where(inside, text[np.clip(places, 0, len(raw) - 1)], 0)
                patterns = np.frombuffer(b"".join(w.text for w in chosen), np.uint8)
                patterns = patterns.reshape(len(chosen), -1)
                edits, ends = aligned(patterns, region)
                good = np.flatnonzero(edits <= [w.edits for w in chosen])
                if len(good):
                    _, back = aligned(patterns[good, ::-1], region[good, ::-1])
                    first = region.shape[1] - back
                    for i, g in enumerate(good):
                        yield (chosen[g], int(starts[g] + first[i]), int(starts[g] + ends[g]), int(edits[g]))


def aligned(patterns: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each pattern against a part of its region, and where that part ends.

    Only cells near the band's diagonals are filled: the column minus the row is
    at least 0 and less than the region's length beyond the pattern's.
    """
    length = patterns.shape[1]
    width = regions.shape[1] - length
    step = np.arange(width, dtype=np.int32)
    cost = np.zeros((len(patterns), width), np.int32)
    far = np.full((len(patterns), 1), length, np.int32)
    for i in range(length):
        same = cost + (regions[:, i : i + width] != patterns[:, i : i + 1])
        skipped = np.concatenate([cost[:, 1:], far], axis=1) + 1
        cost = np.minimum(same, skipped)
        cost = np.minimum.accumulate(cost - step, axis=1) + step
    best = cost.argmin(axis=1)
    return cost[np.arange(len(cost)), best], best + length


def searched(texts: list[bytes], searcher: Searcher) -> dict[tuple[int, int], list]:
    """Matches by (number of the text, item id), in bytes of the text."""
    gap = b"\0" * (WINDOW + 4 * BAND)
    starts = np.cumsum([0, *(len(t) + len(gap) for t in texts)])
    found: dict[tuple[int, int], list] = {}
    for window, start, end, edits in searcher.search(gap.join(texts).translate(_FOLD)):
        at = int(np.searchsorted(starts, max(start, 0) + (end - max(start, 0)) // 2, "right")) - 1
        low = max(0, start - int(starts[at]))
        high = min(len(texts[at]), end - int(starts[at]))
        found.setdefault((at, window.item_id), []).append((low, high, edits, window))
    return found


def _characters(text: bytes, at: int) -> int:
    return len(text[:at].decode(errors="ignore"))


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, one after the other on the driver."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    n = 1
    while True:
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
        sizes = items.groupBy(block.alias("b")).agg(
            F.sum(F.octet_length("text")).alias("s"), F.count("*").alias("n")
        )
        if not sizes.where((F.col("s") > block_bytes) & (F.col("n") > 1)).count():
            break
        n *= 2
    for b in range(n):
        yield [tuple(r) for r in items.where(block == b).distinct().collect()]


def contamination(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Benchmark items in documents: ``DF[doc_id, item_id, windows, edits, spans]``.

    One row per row of ``docs`` and item it holds a window of: how many such
    matches, the fewest edits, and the merged spans in code points. Upper case and
    kinds of white space do not matter. The benchmark is the query set: it is sent
    to the texts in blocks of a checked size, each a narrow pass without a shuffle.
    Null or empty texts and items match nothing, nor do items shorter than a
    q-gram; a null doc_id stays null, an item without an id is left out. Repeated
    rows are reported each. Texts of any length are read whole, in memory that grows with
    the text and not with its repeats. Of equally good alignments the first one in a band
    counts. Empty tables give no rows. Other columns are not read.
    """

    def scan(items: list[tuple[int, str]]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(items)
            for batch in chunks(batches, limit=TEXT_BYTES):
                texts = utf8(batch)
                ids = batch.column("doc_id").to_pylist()
                rows = []
                for (at, item_id), matches in sorted(searched(texts, searcher).items()):
                    spans: list[list[int]] = []
                    for low, high, _, _ in sorted(matches, key=lambda m: m[:2]):
                        if spans and low <= spans[-1][1]:
                            spans[-1][1] = max(high, spans[-1][1])
                        else:
                            spans.append([low, high])
                    spans = [[_characters(texts[at], x) for x in s] for s in spans]
                    rows.append(
                        {"doc_id": ids[at], "item_id": item_id,
                         "windows": len({m[3].text for m in matches}),
                         "edits": min(m[2] for m in matches),
                         "spans": [{"start": a, "end": b} for a, b in spans]}
                    )
                yield pa.RecordBatch.from_pylist(rows, _ARROW)

        return docs.select("doc_id", "text").mapInArrow(run, MATCHES)

    found = None
    for number, items in enumerate(_blocks(benchmark, block_bytes)):
        if number == 0:
            found = scan(items)
            continue
        # Of several blocks each is searched and let go before the next one is fetched.
        if number == 1:
            found = written(found, "contamination")
        found = found.union(written(scan(items), "contamination"))
    return found


_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("windows", pa.int32()),
     ("edits", pa.int32()),
     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` without the documents :func:`contamination` finds an item in; all columns.

    Empty tables, null or empty texts and null ids are handled as there: such rows stay.
    Of several blocks of the benchmark each is one pass over what the last one kept.
    """
    for number, items in enumerate(_blocks(benchmark, block_bytes)):
        if number:
            docs = written(docs, "clean")

        def clean(batch: pa.RecordBatch, items: list = items) -> list[bool]:
            searcher = _searcher(items)
            out: list[bool] = []
            for part in chunks(iter([batch]), limit=TEXT_BYTES):
                hit = {at for at, _ in searched(utf8(part), searcher)}
                out += [i not in hit for i in range(part.num_rows)]
            return out

        docs = filtered(docs, clean)
    return docs


_made: dict[int, tuple[list, Searcher]] = {}


def _searcher(items: list[tuple[int, str]]) -> Searcher:
    """The searcher of a task's items, made once for all its batches."""
    if id(items) not in _made:
        _made.clear()
        _made[id(items)] = (items, Searcher(items))
    return _made[id(items)][1]
