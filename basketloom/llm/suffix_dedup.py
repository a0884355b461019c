"""Suffix-array dedup: bytes of long strings that are in another place too.

Equal strings of ``WINDOW`` bytes choose the same anchor in them, so each window
is judged with the other windows of its anchor's code only. A code whose windows
all lie in equal surroundings, by digests of 128 bits, needs no comparison; of the others each distinct
stretch of text is taken once, with its number of copies, and blocks of whole
codes get a Burrows-Wheeler transform whose intervals are expanded, common
prefixes by increasing value, up to the window length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.llm.anchors import Powers, anchored
from basketloom.llm.common import chunks, utf8, written
from basketloom.llm.intervals import repeated_windows

WINDOW = 400
GRAM = 200
#: Bytes of segments that share a transform, whole codes at a time.
BLOCK_BYTES = 1 << 20
#: Bytes of distinct segments of one code, above which its windows get finer codes.
GROUP_BYTES = 1 << 22
#: Blocks of a task that compares segments, and the most tasks.
TASK_BLOCKS = 4
MAX_TASKS = 20_000
#: Windows of one finer code, by their distance to the anchor; the last level needs no transform.
FINER = (32, 1)



def _key() -> Column:
    """A digest that stands for a whole text."""
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _digest(segment: bytes, place: int) -> tuple[int, int]:
    """128 bits that stand for the bytes of a segment and its anchor's place, as two numbers."""
    both = xxhash.xxh3_128_intdigest(segment, place)
    return _signed(both >> 64), _signed(both & (1 << 64) - 1)


def anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``DF[t, g, c, d, s, n, a]``: windows ``s`` to ``s + n - 1`` of text ``t`` with one anchor.

    ``g`` is the anchor's code, ``a`` its place behind ``s``, and ``c`` and ``d`` are a
    digest of all bytes of these windows. One row per row of ``docs`` and anchor. Narrow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2
        for batch in chunks(batches):
            owners, columns = [], [[] for _ in kinds]
            for i, text in enumerate(utf8(batch)):
                codes, places, firsts, lasts = anchored(
                    np.frombuffer(text, np.uint8), window, gram, powers
                )
                first, last, place = firsts.tolist(), lasts.tolist(), (places - firsts).tolist()
                columns[0].append(codes.view(np.int64))
                digests = [_digest(text[f : e + window], p) for f, e, p in zip(first, last, place)]
                columns[1].append([c for c, _ in digests])
                columns[2].append([d for _, d in digests])
                columns[3].append(firsts)
                columns[4].append(lasts - firsts + 1)
                columns[5].append(places - firsts)
                owners.append(np.full(len(codes), i))
            arrays = [pa.array(np.concatenate(c).astype(k.to_pandas_dtype())) for c, k in zip(columns, kinds)]
            t = batch.column("t").take(pa.array(np.concatenate(owners)))
            yield pa.RecordBatch.from_arrays([t, *arrays], ["t", "g", "c", "d", "s", "n", "a"])

    return docs.select(_key().alias("t"), "text").mapInArrow(
        run, "t binary, g bigint, c bigint, d bigint, s bigint, n int, a int"
    )


def _texts(docs: DataFrame) -> DataFrame:
    """Each text once: ``DF[t, text]``."""
    return docs.select(_key().alias("t"), "text").dropDuplicates(["t"])


def _segments(docs: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """The bytes of rows ``DF[t, g, c, d, s, n, copies]``: ``DF[g, c, d, copies, segment]``."""
    wanted = rows.groupBy("t").agg(
        F.collect_list(F.struct("g", "c", "d", "s", "n", "copies")).alias("rows")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            out = []
            for text, some in zip(utf8(batch), batch.column("rows").to_pylist()):
                for r in some:
                    end = r["s"] + r["n"] - 1 + window
                    out.append((r["g"], r["c"], r["d"], r["copies"], text[r["s"] : end]))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 4 + [pa.binary()])],
                ["g", "c", "d", "copies", "segment"],
            )

    return _texts(docs).join(wanted, "t").select("text", "rows").mapInArrow(
        run, "g bigint, c bigint, d bigint, copies bigint, segment binary"
    )


def _runs(flags: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2])]


_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _compared(segments: DataFrame, window: int, block: int, tasks: int) -> DataFrame:
    """``DF[g, c, d, runs]``: the repeated windows of each segment among those of its code."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated_windows([r[4] for r in rows], [r[3] for r in rows], window)
        return pa.RecordBatch.from_arrays(
            [*(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)),
             pa.array([_runs(f) for f in found], _RUNS)],
            ["g", "c", "d", "runs"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # whole codes, and the last one so far
        size = 0
        for batch in chunks(batches, "segment"):
            columns = [batch.column(c).to_pylist() for c in ("g", "c", "d", "copies", "segment")]
            for row in zip(*columns):
                if size >= block and row[0] != held[-1][0]:
                    yield out(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield out(held)

    return segments.repartition(tasks, "g").sortWithinPartitions("g", "c", "d").mapInArrow(
        run, "g bigint, c bigint, d bigint, runs array<struct<first: int, last: int>>"
    )


def _finer(docs: DataFrame, rows: DataFrame, window: int, width: int) -> DataFrame:
    """The windows of ``rows`` again, by their distance to the anchor and what all of a code share.

    Equal windows have the anchor at the same distance, so they meet in one code
    again. The more of a window the code stands for, the fewer texts share it.
    """
    wanted = rows.groupBy("t").agg(F.collect_set(F.struct("g", "s", "n", "a")).alias("rows"))
    # Every row of docs with the text is one place, so copies are counted as before.
    places = docs.select(_key().alias("t"), "text").join(written(wanted, "wanted"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.int32()] * 2
        for batch in chunks(batches):
            owners, out = [], []
            rows = batch.column("rows").to_pylist()
            for i, (text, some) in enumerate(zip(utf8(batch), rows)):
                for r in some:
                    anchor, last = r["s"] + r["a"], r["s"] + r["n"] - 1
                    for b in range((anchor - last) // width, r["a"] // width + 1):
                        high = min(last, anchor - b * width)
                        low = max(r["s"], anchor - (b + 1) * width + 1)
                        start = anchor - b * width
                        core = text[start : max(start, start - width + 1 + window)]
                        code = _signed(xxhash.xxh3_64_intdigest(core, b) ^ (r["g"] & (2**64 - 1)))
                        segment = text[low : high + window]
                        digest = _digest(segment, anchor - low)
                        out.append((code, *digest, low, high - low + 1, anchor - low))
                        owners.append(i)
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("t").take(pa.array(owners, pa.int64())),
                 *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["t", "g", "c", "d", "s", "n", "a"],
            )

    return places.mapInArrow(run, "t binary, g bigint, c bigint, d bigint, s bigint, n int, a int")


def _marks(
    docs: DataFrame, rows: DataFrame, window: int, block: int, most: int, finer: tuple[int, ...]
) -> DataFrame:
    """Removed bytes of texts: ``DF[t, first, last]``, ``last`` being the one behind."""
    differ = (F.min("c") != F.max("c")) | (F.min("d") != F.max("d"))
    codes = rows.groupBy("g").agg(F.count("*").alias("rows"), differ.alias("mixed"))
    codes = written(codes.where("rows > 1").drop("rows"), "codes")
    shared = written(rows.join(codes, "g"), "shared")
    end = F.col("s") + F.col("n") - 1 + window
    same = shared.where("NOT mixed").select("t", F.col("s").alias("first"), end.alias("last"))

    mixed = shared.where("mixed")
    distinct = written(
        mixed.groupBy("g", "c", "d").agg(
            F.min(F.struct("t", "s", "n")).alias("one"), F.count("*").alias("copies")
        ),
        "distinct",
    )
    # The sizes of codes are known before a segment is fetched: those above ``most`` get
    # finer codes, the others go whole to as many tasks as their bytes ask for.
    sizes = written(
        distinct.groupBy("g").agg(F.sum(F.col("one.n") - 1 + window).alias("bytes")), "sizes"
    )
    fits = F.col("bytes") <= most if finer else F.lit(True)
    total = sizes.where(fits).agg(F.sum("bytes")).first()[0] or 0
    some = distinct.join(sizes.where(fits).select("g"), "g", "left_semi")
    segments = _segments(docs, some.select("one.*", "g", "c", "d", "copies"), window)
    tasks = min(MAX_TASKS, 1 + total // (TASK_BLOCKS * block))
    judged = written(_compared(segments, window, block, tasks), "judged")
    runs = judged.select("g", "c", "d", F.explode("runs").alias("run"))
    other = mixed.join(runs, ["g", "c", "d"]).select(
        "t", (F.col("s") + F.col("run.first")).alias("first"),
        (F.col("s") + F.col("run.last") + window).alias("last"),
    )
    marks = same.union(other)
    large = sizes.where(~fits).select("g")
    if finer and not large.isEmpty():
        again = written(_finer(docs, mixed.join(large, "g"), window, finer[0]), "finer")
        marks = marks.union(_marks(docs, again, window, block, most, finer[1:]))
    return marks


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(last, out[-1][1])
        else:
            out.append([first, last])
    return [tuple(s) for s in out]


def repeated_spans(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    block: int = BLOCK_BYTES,
    most: int = GROUP_BYTES,
) -> DataFrame:
    """Bytes covered by a string of ``window`` bytes that also starts elsewhere.

    ``DF[doc_id, text, spans: array<struct<first, last>>]``, one row per row of
    ``docs``; spans may overlap. Strings do not cross texts; elsewhere is another
    place of the same text, or any row of ``docs``, equal texts included. A null
    text counts as empty.
    """
    if not 0 < gram <= window:
        raise ValueError("an anchor must fit into the window")
    rows = written(anchor_rows(docs, window, gram), "anchors")
    marks = _marks(docs, rows, window, block, most, FINER)
    spans = marks.groupBy("t").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    texts = docs.select("doc_id", "text", _key().alias("t"))
    return texts.join(written(spans, "spans"), "t", "left").select("doc_id", "text", "spans")


def remove_repeats(docs: DataFrame, **settings: int) -> DataFrame:
    """``DF[doc_id, kept: binary, n_bytes, n_removed, n_spans]`` after :func:`repeated_spans`."""
    return _removed(docs, True, settings)


def repeat_digests(docs: DataFrame, **settings: int) -> DataFrame:
    """``DF[doc_id, n_bytes, n_removed, n_spans, kept_sha256]``: what is left only as a digest.

    One row per row; repeated rows are places of their own and all lose what they share.
    A null text counts as empty, a null id stays null, an empty table gives no rows, other
    columns are not read. A long text is alone in its batch; its bytes are held whole.
    """
    return _removed(docs, False, settings)


def _removed(docs: DataFrame, texts: bool, settings: dict[str, int]) -> DataFrame:
    kept = "kept binary" if texts else "kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for text, spans in zip(utf8(batch), batch.column("spans").to_pylist()):
                cut, parts, at = _merged(spans or []), [], 0
                for first, last in cut:
                    parts.append(text[at:first])
                    at = last
                left = b"".join([*parts, text[at:]])
                result = left if texts else hashlib.sha256(left).hexdigest()
                rows.append((len(text), len(text) - len(left), len(cut), result))
            kinds = [pa.int64()] * 3 + [pa.binary() if texts else pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()),
                 *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", kept.split()[0]],
            )

    return repeated_spans(docs, **settings).mapInArrow(
        run, f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, {kept}"
    )
