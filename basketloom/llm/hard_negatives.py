"""Hard negatives from exact integer inner products, several candidates to a multiplication.

Components are whole numbers. Those of several candidates, biased to be at least
zero, lie side by side in fields of one wide integer; an anchor's component times
that integer is a product in every field, and the sum over the components leaves the
score of each candidate in its own field, as no field can overflow. Integers of up to
53 bits are exact as doubles, so the sums are one matrix product; wider ones are
Python's integers.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketloom.llm.common import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Least and greatest score of a negative, in per cent of the positive's.
LOW, HIGH = 50, 95

#: Rows of a block of anchors and of candidates, and anchors scored at a time.
BLOCK = 4096
STEP = 256

#: Bits of a double that hold an integer exactly; fields of a wider integer.
WORD_BITS = 53
WIDE_FIELDS = 8

_NONE = np.iinfo(np.int64).min

_POSITIVE = "anchor_id bigint, positive_id bigint, positive_score bigint"
_NEGATIVE = f"{_POSITIVE}, negative_id bigint, negative_score bigint"


class Products:
    """Inner products of anchors with rows of whole numbers, several rows to a word."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray) -> None:
        most = max(1, _largest(anchors)) * max(1, _largest(rows)) * rows.shape[1]
        # Biased numbers are up to twice as large; beyond this a double is not exact.
        self.doubles = 4 * most < 1 << WORD_BITS
        anchors, rows = self._whole(anchors), self._whole(rows)
        self.n = len(rows)
        self.low, bias = anchors.min(axis=0), rows.min(axis=0)
        self.lifted, biased = anchors - self.low, rows - bias
        # No field holds more than this, whichever row is in it.
        bound = int((self.lifted @ biased.max(axis=0)).max())
        self.width = max(1, bound.bit_length())
        self.fields = WORD_BITS // self.width if self.doubles else WIDE_FIELDS
        self.words = self._packed(biased)
        # What the biases take out of the products: (a + low)(c + bias) less a * c.
        self.of_anchor = self.lifted @ bias + self.low @ bias
        self.of_row = biased @ self.low

    def _whole(self, numbers: np.ndarray) -> np.ndarray:
        return numbers.astype(np.float64) if self.doubles else np.frompyfunc(int, 1, 1)(numbers)

    def _packed(self, biased: np.ndarray) -> np.ndarray:
        """Row ``k * words + i`` is field ``k`` of word ``i``."""
        words = -(-self.n // self.fields)
        out = np.zeros((words, biased.shape[1]), biased.dtype)
        for k in range(self.fields):
            part = biased[k * words : (k + 1) * words]
            out[: len(part)] += part * (1 << self.width * k)
        return out

    def scores(self, some: slice | np.ndarray) -> np.ndarray:
        """Scores of ``some`` anchors with all rows, as 64-bit integers."""
        sums = self.lifted[some] @ self.words.T
        if self.doubles:
            sums = sums.astype(np.int64)
        mask = (1 << self.width) - 1
        fields = [(sums >> (self.width * k)) & mask for k in range(self.fields)]
        found = np.concatenate(fields, axis=1)[:, : self.n]
        rest = self.of_anchor[some][:, None] + self.of_row[None, :]
        return (found + (rest.astype(np.int64) if self.doubles else rest)).astype(np.int64)


def _largest(numbers: np.ndarray) -> int:
    return max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)))


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (row, column) of each row's ``k`` highest scores, ties to the smaller column.

    ``_NONE`` stands for no score.
    """
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    else:
        least = np.full(len(scores), _NONE)
    row, column = np.nonzero((scores >= least[:, None]) & (scores != _NONE))
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of numbers as rows, shorter ones with zeros behind them."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), max(1, sizes.max(initial=0))), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _matrices(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    found = [_matrix(c) for c in columns]
    width = max(m.shape[1] for m in found)
    return [np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in found]


def _block_positives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of a block of candidates, the first ``k`` of each anchor's label, itself left out."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = [np.zeros((3, 0), np.int64)]
        if anchors.num_rows and rows.num_rows:
            rows = rows.sort_by("vec_id")
            a, c = _matrices(anchors["parts"], rows["parts"])
            a_id, c_id = anchors["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
            a_label, c_label = anchors["label"].to_numpy(), rows["label"].to_numpy()
            for label in np.intersect1d(a_label, c_label):
                same = np.flatnonzero(c_label == label)
                mine = np.flatnonzero(a_label == label)
                products = Products(a[mine], c[same])
                for at in range(0, len(mine), STEP):
                    some = mine[at : at + STEP]
                    scores = products.scores(slice(at, at + STEP))
                    scores[a_id[some][:, None] == c_id[same][None, :]] = _NONE
                    row, column = best(scores, k)
                    out.append(
                        np.stack([a_id[some][row], c_id[same][column], scores[row, column]])
                    )
        return pa.table(
            list(np.concatenate(out, axis=1)), ["anchor_id", "positive_id", "positive_score"]
        )

    return run


def _block_negatives(k: int, low: int, high: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of a block of candidates, the first ``k`` of other labels within each positive's scores."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = [np.zeros((5, 0), np.int64)]
        if anchors.num_rows and rows.num_rows:
            rows = rows.sort_by("vec_id")
            a, c = _matrices(anchors["parts"], rows["parts"])
            a_id, c_id = anchors["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
            a_label, c_label = anchors["label"].to_numpy(), rows["label"].to_numpy()
            positives = anchors["positives"].to_pylist()
            products = Products(a, c)
            for at in range(0, len(a), STEP):
                some = slice(at, at + STEP)
                scores = products.scores(some)
                scores[a_label[some][:, None] == c_label[None, :]] = _NONE
                for j in range(max(map(len, positives[some]))):
                    given = [p[j] if j < len(p) else None for p in positives[some]]
                    bounds = [
                        (-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100)
                        if p else (1, 0) for p in given
                    ]
                    least, most = np.array(bounds, np.int64).T[:, :, None]
                    inside = (scores >= least) & (scores <= most) & (scores != _NONE)
                    row, column = best(np.where(inside, scores, _NONE), k)
                    ids = np.array([p["positive_id"] if p else 0 for p in given], np.int64)
                    own = np.array([p["positive_score"] if p else 0 for p in given], np.int64)
                    out.append(
                        np.stack([a_id[some][row], ids[row], own[row], c_id[column],
                                  scores[row, column]])
                    )
        return pa.table(
            list(np.concatenate(out, axis=1)),
            ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
        )

    return run


def whole_items(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``DF[vec_id, label, parts]``: usable rows, components as whole numbers, one row an id.

    Rows with a null id, label or vector or any null or non-finite component are
    left out. Of rows with one id the first by label and components stands for all.
    A component that no 64-bit integer holds is the nearest one.
    """
    x = F.col("embedding").cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    items = vectors.where("vec_id IS NOT NULL AND label IS NOT NULL").where(usable).select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("int"),
        F.transform(x, lambda v: F.floor(v * scale)).alias("parts"),
    )
    first = items.groupBy("vec_id").agg(F.min(F.struct("label", "parts")).alias("item"))
    return first.select("vec_id", "item.label", "item.parts")


def _pairs(anchors: DataFrame, rows: DataFrame, groups: int, blocks: int, run: Callable,
           schema: str) -> DataFrame:
    """``run`` on every block of anchors with every block of candidates, one task a pair or so."""
    n = groups * blocks
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int")
    left = anchors.withColumns({"a": group, "c": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    right = rows.withColumns({"c": block, "a": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    sides = [side.repartition(n, "a", "c").groupBy("a", "c") for side in (left, right)]
    return sides[0].cogroup(sides[1]).applyInArrow(run, schema)


def _first(df: DataFrame, keys: list[str], score: str, item: str, k: int, name: str) -> DataFrame:
    """The first ``k`` rows of each key by score, ties to the smaller id; ``name`` is the rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(item))
    return df.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block: int = BLOCK,
) -> DataFrame:
    """Negatives whose score is close to a positive's, for every anchor and positive.

    ``vectors`` is ``DF[vec_id, label, embedding]``, ``anchors`` says which rows ask.
    An anchor's positives are its first ``positives`` other rows of its label, and the
    negatives of each are the first ``negatives`` rows of other labels with a score of
    ``low`` to ``high`` per cent of the positive's; higher inner products of the
    components ``floor(SCALE * x)`` come first, ties by smaller id. Gives
    ``DF[anchor_id, positive_id, rank, negative_id, positive_score, negative_score]``.

    Rows with a null id, label or vector or a null or non-finite component take no
    part; of repeated ids one row does (see :func:`whole_items`). A shorter vector
    counts as followed by zeros, an empty one scores 0. An anchor without positives
    and a positive without negatives have no rows; an empty table gives none. Other
    columns are not read. Scores beyond 64 bits are an error.

    Every anchor meets every row, in blocks of about ``block`` ids of each side dealt
    out by hashes of the id, so that no label or repeated vector makes a block larger;
    a task holds one pair of blocks. What leaves it are a few rows per anchor.
    """
    items = written(whole_items(vectors), "vectors")
    asking = items.where(anchors)
    groups, blocks = (max(1, -(-side.count() // block)) for side in (asking, items))
    found = _pairs(asking, items, groups, blocks, _block_positives(positives), _POSITIVE)
    top = _first(found, ["anchor_id"], "positive_score", "positive_id", positives, "place")
    lists = top.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    ready = written(asking.join(lists, "vec_id"), "positives")
    near = _pairs(ready, items, groups, blocks, _block_negatives(negatives, low, high), _NEGATIVE)
    ranked = _first(
        near, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives, "rank"
    )
    return ranked.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
