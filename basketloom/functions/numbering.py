"""Row numbers for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketloom.sources.durable import durable

#: Rows of a group that one task may sort, and rows a task is dealt.
GROUP_ROWS = 100_000
TASK_ROWS = 1_000_000


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    buckets: Sequence[Column],
    number: str,
    total: str | None = None,
) -> DataFrame:
    """Add ``row_number() OVER (PARTITION BY keys ORDER BY order_by)`` as ``number``.

    A plain window sorts a whole group in one task. Here a group is cut into
    ``buckets``, coarse expressions that never decrease along ``order_by``: rows
    are numbered inside a bucket and shifted by the size of the buckets before
    it, so one task only holds a bucket, or one row per bucket of a group.

    ``total`` adds the group's size. Keys and buckets must not be null.
    """
    names = [f"_bucket{i}" for i in range(len(buckets))]
    cut = df.withColumns(dict(zip(names, buckets)))
    sizes = cut.groupBy(*keys, *names).agg(F.count("*").alias("_rows"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.withColumns(
        {
            "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "_total": F.sum("_rows").over(group),
        }
    ).drop("_rows")
    inside = F.row_number().over(Window.partitionBy(*keys, *names).orderBy(*order_by))
    out = cut.join(shifts, [*keys, *names]).withColumn(
        number, F.col("_before") + inside
    )
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop(*names, "_before", "_total")


def task_count(df: DataFrame) -> int:
    """Tasks that ``df``, a scan, is dealt to so that none gets more than its rows."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


def large_groups(df: DataFrame, keys: Sequence[str], most: int | None = None) -> DataFrame | None:
    """``DF[keys]`` of the groups of more than ``most`` rows; ``None`` where there are none.

    They are at most one in ``most`` rows, few enough to be sent to all tasks.
    """
    most = GROUP_ROWS if most is None else most
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    large = durable(sizes.where(F.col("_rows") > most).select(*keys), "large")
    return None if large.isEmpty() else F.broadcast(large)


def number_groups(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    buckets: Sequence[Column],
    number: str,
    total: str | None = None,
) -> DataFrame:
    """:func:`number_rows` where most groups are small: those are shuffled once, and whole.

    Only groups of more than ``GROUP_ROWS`` rows are cut into buckets. ``df`` is read
    several times, so it should be a table. Rows with a null key or bucket are left out.
    """
    large = large_groups(df, keys)
    group = Window.partitionBy(*keys)
    usual = df if large is None else df.join(large, list(keys), "left_anti")
    out = usual.dropna(subset=list(keys)).repartition(task_count(df), *keys)
    out = out.withColumn(number, F.row_number().over(group.orderBy(*order_by)).cast("bigint"))
    if total:
        out = out.withColumn(total, F.count("*").over(group))
    for bucket in buckets:
        out = out.where(bucket.isNotNull())
    if large is None:
        return out
    cut = df.join(large, list(keys), "left_semi")
    return out.unionByName(number_rows(cut, keys, order_by, buckets, number, total))


def dense_ids(df: DataFrame, column: str, buckets: int = 4096) -> DataFrame:
    """Map every value of an integer ``column`` to 0..n-1: ``DF[column, dense_id:int]``.

    For ids outside the 32-bit range the matrix factorisation accepts. The
    numbering follows (id modulo ``buckets``, id), so it does not depend on how
    the rows are partitioned.
    """
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    slot = F.pmod(F.col(column), F.lit(buckets))
    numbered = number_rows(ids, [], [column], [slot], "_number")
    return numbered.select(column, (F.col("_number") - 1).cast("int").alias("dense_id"))


def number_sorted(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str], number: str
) -> DataFrame:
    """Like :func:`number_rows`, without buckets to choose: rows are dealt out by ranges.

    The ranges are of the keys and the order together, so a group of any size is cut
    wherever a range ends, as long as ``order_by`` tells its rows apart. The sorted rows
    are written once; a group then has one row of counts for each range it is in, which
    give the numbers before. Keys may be null.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    by = [*(F.col(c) for c in keys), *order]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    cut = durable(
        df.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(
            {"_range": F.spark_partition_id(), "_place": place}
        ),
        "sorted",
    )
    names = {c: f"_of_{c}" for c in keys}
    sizes = cut.groupBy(*keys, "_range").agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    )
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    shifts = sizes.select(
        *(F.col(c).alias(n) for c, n in names.items()),
        F.col("_range").alias("_of_range"),
        (before - F.col("_first") + 1).alias("_shift"),
    )
    same = F.col("_range") == F.col("_of_range")
    for c, n in names.items():
        same = same & F.col(c).eqNullSafe(F.col(n))
    return cut.join(shifts, same).select(
        *df.columns, (F.col("_shift") + F.col("_place")).alias(number)
    )
