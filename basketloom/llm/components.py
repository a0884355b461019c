"""Connected components of links between numbered nodes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm.common import written

#: Links a task joins into a forest at a time.
FOREST_LINKS = 1 << 17


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node it reaches) with the components of the given links."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        # The smaller label goes to the other label's own node, so whole trees move.
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(a, b)], ["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        held.append(tuple(batch.column(i).to_numpy() for i in range(2)))
        if sum(len(a) for a, _ in held) >= FOREST_LINKS:
            yield out(*map(np.concatenate, zip(*held)))
            held = []
    if held:
        yield out(*map(np.concatenate, zip(*held)))


def components(links: DataFrame) -> DataFrame:
    """``DF[node, root]`` of every linked node, the root being its component's smallest.

    ``links`` is ``DF[a, b]`` of bigint; direction, repeats and loops do not
    matter. Tasks first replace their links by forests. Then each round links the
    larger neighbours of a node to its smallest one, and after that the smaller
    ones, until nothing changes: a number of rounds that grows with the logarithm
    of the longest chain. Every round is a table in the shared folder. Smallest
    neighbours are partial aggregates and joined as written tables, so a node of
    very many links is split over tasks.
    """
    pairs = links.where("a <> b").select("a", "b")
    now = written(pairs.mapInArrow(_forests, "a bigint, b bigint").distinct(), "links")

    def state(df: DataFrame) -> tuple:
        hashes = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        return tuple(df.agg(F.count("*"), hashes).first())

    before, after = None, state(now)
    while before != after and after[0]:
        both = now.union(now.select("b", "a"))
        least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), "large")
        # Every link now leads from a node to a smaller one.
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a <> b").union(least.select("a", F.col("m").alias("b")))
        now = written(small.distinct(), "links")
        before, after = after, state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct()
    )
