"""SimHash near-dedup: fingerprints a few bits apart, found by deletion variants.

A fingerprint of 64 bits is cut into two segments. Of two fingerprints that
differ in three bits at most, one segment differs in one bit at most, so both
have the same variant of it: the segment with one bit taken for a wildcard.
Variants are joined by equality and the fingerprints behind them verified.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from basketloom.llm.common import chunks, utf8, written
from basketloom.llm.components import components, forest

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
SEGMENTS = 2
SEGMENT_BITS = 64 // SEGMENTS

#: Fingerprints with one variant that a task compares; more are cut by further variants.
MAX_BUCKET = 2048

#: Hashes whose bits are counted at a time.
HASHES = 1 << 15


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text in UTF-8: bits set in over half of its shingles' hashes."""
    split = text.lower().split()
    if not split:
        return 0
    n = max(1, len(split) - words + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, HASHES):
        hashes = np.array(
            [xxhash.xxh64_intdigest(b" ".join(split[i : i + words]), SEED)
             for i in range(at, min(n, at + HASHES))],
            "<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``DF[doc_id, fp: bigint]`` of every row, the 64 bits as a signed number. Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            fps = np.array([fingerprint(t, words) for t in utf8(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(fps.view(np.int64))],
                ["doc_id", "fp"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fp bigint")


def _variants(rows: DataFrame, bits: int) -> DataFrame:
    """One row per variant of either half of the ``bits`` bits from ``start`` on.

    ``DF[key, start, fp]`` to ``DF[key, start, fp, n]``: the new key stands for the
    old one and the variant, ``start`` for the half left, ``n`` for the
    fingerprints with that key. Alone, or where the wildcard bit is the same in
    all (they meet under the first variant), a fingerprint is left out.
    """
    half = bits // 2
    one = rows.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(bits - 1)))).selectExpr(
        "key", "start", "fp", f"v div {half} AS h", f"v % {half} AS i"
    )
    part = one.selectExpr(
        "key", "h", "i", "fp", f"CAST(start + (1 - h) * {half} AS int) AS start",
        f"shiftrightunsigned(fp, CAST(start + h * {half} AS int)) & {(1 << half) - 1}L AS part",
    )
    keyed = part.selectExpr(
        "xxhash64(key, h, i, part & ~shiftleft(1L, i)) AS key", "start", "fp", "i",
        "shiftright(part, i) & 1 AS bit",
    )
    bucket = Window.partitionBy("key")
    counted = keyed.withColumns(
        {"n": F.count("*").over(bucket), "ones": F.sum("bit").over(bucket)}
    )
    useful = (F.col("i") == 0) | F.col("ones").between(1, F.col("n") - 1)
    return counted.where((F.col("n") > 1) & useful).select("key", "start", "fp", "n")


def close_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links between the fingerprints of a bucket, each link verified."""
    unsigned = fps.view(np.uint64)
    a, b = [fps[:0]], [fps[:0]]
    for i in range(len(fps) - 1):
        near = fps[i + 1 :][np.bitwise_count(unsigned[i + 1 :] ^ unsigned[i]) <= max_bits]
        a.append(near)
        b.append(np.full(len(near), fps[i]))
    return forest(np.concatenate(a), np.concatenate(b))


def _linked(max_bits: int) -> Callable:
    """Links of the buckets of a partition sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 2
        for batch in batches:
            keys, fps = (
                np.concatenate([r, batch.column(i).to_numpy()]) for i, r in enumerate(rest)
            )
            # The last bucket may go on in the next batch.
            last = int(np.searchsorted(keys, keys[-1]))
            yield out(keys[:last], fps[:last])
            rest = [keys[last:], fps[last:]]
        yield out(*rest)

    def out(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(keys)) + 1
        starts = np.concatenate([[0], cuts]).astype(np.int64)
        ends = np.concatenate([cuts, [len(keys)]]).astype(np.int64)
        pairs = starts[ends - starts == 2]
        x, y = fps[pairs], fps[pairs + 1]
        near = np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= max_bits
        found = [(x[near], y[near])]
        for g in np.flatnonzero(ends - starts > 2):
            found.append(close_links(fps[starts[g] : ends[g]], max_bits))
        a, b = map(np.concatenate, zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def fingerprint_links(
    fps: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET
) -> DataFrame:
    """Links that join all distinct fingerprints ``max_bits`` apart or less: ``DF[a, b]``.

    Not all pairs: of each bucket a forest of its verified links, which has the
    same components. A bucket of more than ``max_bucket`` fingerprints is cut by
    variants of the half its key says nothing of, and so on. What is left to
    differ after the last cut are 8 bits, so no bucket of that level is large.
    """
    if not 0 <= max_bits < 2 * SEGMENTS:
        raise ValueError("two segments of one wildcard find at most three differing bits")
    if max_bucket < 256:
        raise ValueError("buckets of 256 fingerprints cannot be cut further")
    rows = fps.selectExpr("0L AS key", "0 AS start", "fp")
    links = None
    for bits in (64, 32, 16, 8):
        found = written(_variants(rows, bits), "variants")
        small = found.where(F.col("n") <= max_bucket).select("key", "fp")
        some = small.repartition("key").sortWithinPartitions("key").mapInArrow(
            _linked(max_bits), "a bigint, b bigint"
        )
        links = some if links is None else links.union(some)
        rows = found.where(F.col("n") > max_bucket).drop("n")
        if rows.isEmpty():
            break
    return links


def _grouped(
    docs: DataFrame, max_bits: int, words: int, max_bucket: int
) -> tuple[DataFrame, DataFrame]:
    """``DF[doc_id, fp]`` of every row, and ``DF[fp, root, component_id]`` of every fingerprint.

    ``root`` names a group; two groups may have one smallest id, if it is on several rows.
    """
    fps = written(fingerprints(docs, words), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = written(components(fingerprint_links(nodes, max_bits, max_bucket)), "roots")
    known = written(nodes.join(roots, F.col("fp") == F.col("node")).drop("node"), "known")
    least = written(known.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    linked = known.join(least, "root").select("fp", "root", "component_id")
    single = nodes.join(roots, F.col("fp") == F.col("node"), "left_anti")
    alone = single.select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id"))
    return fps, written(linked.union(alone), "groups")


def simhash_groups(
    docs: DataFrame,
    max_bits: int = MAX_BITS,
    words: int = SHINGLE_WORDS,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """Groups of documents that links of close fingerprints join, one row per row of ``docs``.

    ``DF[doc_id, fingerprint, component_id]``: 16 hex digits, and the smallest id
    of the group. Texts without a word, null or empty, have fingerprint zero and
    are linked like others. Equal fingerprints are one node, so copies cost no
    links. Rows without an id get a component by the others, null if all of the
    group are so; repeated rows give repeated rows. An empty table gives no rows.
    Other columns are not read.
    """
    fps, groups = _grouped(docs, max_bits, words, max_bucket)
    return fps.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _spare(name: str, columns: list[str]) -> str:
    """A column name that is not in use, whatever the case of its letters."""
    used = {c.lower() for c in columns}
    while name.lower() in used:
        name += "_"
    return name


def _with_fingerprint(docs: DataFrame, name: str, words: int) -> DataFrame:
    """``docs`` with the fingerprint of each row behind its columns. Narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            fps = np.array([fingerprint(t, words) for t in utf8(batch)], np.uint64)
            yield batch.append_column(name, pa.array(fps.view(np.int64)))

    schema = StructType([*docs.schema.fields, StructField(name, LongType())])
    return docs.mapInArrow(run, schema)


def keep_one(
    docs: DataFrame,
    max_bits: int = MAX_BITS,
    words: int = SHINGLE_WORDS,
    max_bucket: int = MAX_BUCKET,
) -> DataFrame:
    """``docs`` with one row of each group of :func:`simhash_groups`, all columns.

    The row of the smallest id stays; of several rows with it, one of the smallest
    fingerprint. Rows without an id stay only in groups of nothing else. So every
    group has just one row, also where an id is on rows of several groups. Extra
    columns are kept, whatever their names; an empty table gives no rows.

    An id that one row has is enough to find it; only rows of other ids have their
    fingerprints computed again.
    """
    fps, groups = _grouped(docs, max_bits, words, max_bucket)
    first = fps.join(groups, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = written(
        first.groupBy("root").agg(
            F.min("fp").alias("fp"), F.first("component_id").alias("doc_id")
        ).select("doc_id", "fp"),
        "chosen",
    )
    counts = fps.groupBy("doc_id").agg(F.count("*").alias("n"))
    shared = written(counts.where("n > 1 OR doc_id IS NULL").select("doc_id"), "shared-ids")
    named = docs.join(chosen.select("doc_id"), "doc_id", "left_semi").select(docs.columns)
    if shared.isEmpty():
        return named
    sure = named.join(shared, "doc_id", "left_anti").select(docs.columns)
    fp = _spare("fp", docs.columns)
    same_id = docs["doc_id"].eqNullSafe(shared["doc_id"])
    unsure = _with_fingerprint(docs.join(shared, same_id, "left_semi"), fp, words)
    wanted = unsure["doc_id"].eqNullSafe(chosen["doc_id"]) & (unsure[fp] == chosen["fp"])
    kept = unsure.join(chosen, wanted, "left_semi").dropDuplicates(["doc_id", fp])
    return sure.union(kept.select(docs.columns))
