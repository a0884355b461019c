"""Two-level numbering equals a plain window, also for a group with a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketloom.functions import numbering
from basketloom.functions.numbering import dense_ids, number_groups, number_rows, number_sorted
from basketloom.sources.durable import durable
from basketloom.functions.splits import split_name


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows, a third of them of key 0."""
    i = F.col("id")
    return spark.range(30_000).select(
        F.when(i % 3 == 0, 0).otherwise(i % 500).alias("key"),
        F.pmod(F.xxhash64("id"), F.lit(5_000)).alias("position"),
        i.alias("row_id"),
    )


@pytest.mark.parametrize("bits", [0, 6, 40])
def test_equals_plain_window(skewed, bits):
    order = ["position", "row_id"]
    got = number_rows(skewed, ["key"], order, [F.shiftright("position", bits)], "n", "size")
    key = Window.partitionBy("key")
    want = skewed.withColumn("n", F.row_number().over(key.orderBy(*order))).withColumn(
        "size", F.count("*").over(key)
    )
    columns = ["key", *order, "n", "size"]
    assert got.columns == ["key", "position", "row_id", "n", "size"]
    assert got.select(columns).exceptAll(want.select(columns)).isEmpty()
    assert got.count() == 30_000


def test_no_task_holds_the_hot_group(skewed):
    """Rows are only ever shuffled by key and bucket, never by key alone."""
    plan = number_rows(
        skewed, ["key"], ["position"], [F.shiftright("position", 6)], "n"
    )._jdf.queryExecution().executedPlan().toString()
    by_key = [line for line in plan.splitlines() if "Exchange hashpartitioning(key" in line]
    alone = [line for line in by_key if "_bucket0" not in line]
    assert by_key
    # Only the bucket sizes meet by key, below their own aggregate.
    assert len(alone) <= 1


def test_dense_ids(spark):
    wide = spark.range(1000).select((F.col("id") * 7_000_000_019).alias("user_id"))
    ids = dense_ids(wide.unionAll(wide), "user_id", buckets=16)
    assert dict(ids.dtypes)["dense_id"] == "int"
    got = sorted(r.dense_id for r in ids.collect())
    assert got == list(range(1000))
    again = dense_ids(wide.repartition(5), "user_id", buckets=16)
    assert ids.exceptAll(again).isEmpty()


def test_splits_are_complete_and_stable(spark):
    users = spark.range(-50, 20_000).withColumnRenamed("id", "user_id")
    weights = {"train": 0.7, "validation": 0.15, "test": 0.15}
    split = users.withColumn("split", split_name("user_id", weights))
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 20_050
    for name, weight in weights.items():
        assert abs(sizes[name] / 20_050 - weight) < 0.02
    moved = users.repartition(7).withColumn("split", split_name("user_id", weights))
    assert split.exceptAll(moved).isEmpty()
    other = users.withColumn("split", split_name("user_id", weights, seed=7))
    assert not split.exceptAll(other).isEmpty()


def test_split_of_large_ids(spark):
    ids = spark.createDataFrame([(2**63 - 1,), (-(2**63),)], "user_id bigint")
    names = ids.select(split_name("user_id", {"a": 1, "b": 1}).alias("s")).collect()
    assert all(r.s in ("a", "b") for r in names)


@pytest.mark.parametrize("keys", [["key"], []])
def test_sorted_numbers_equal_plain_window(skewed, keys):
    rows = skewed.withColumn("key", F.when(F.col("key") != 7, F.col("key")))  # 7 becomes null
    order = [F.desc("position"), F.asc("row_id")]
    got = number_sorted(rows, keys, order, "n")
    want = rows.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    assert got.columns == want.columns == ["key", "position", "row_id", "n"]
    assert got.exceptAll(want).isEmpty() and got.count() == 30_000


def test_sorted_ranges_cut_the_hot_group(skewed):
    """A third of the rows has one key, and one count; no range has many more than its share."""
    rows = skewed.withColumn("n", F.when(F.col("key") == 0, 1).otherwise(F.col("key")))
    for keys, order in ((["key"], ["position", "row_id"]), ([], [F.desc("n"), "row_id"])):
        got = number_sorted(rows, keys, order, "number")
        cut = got._jdf.queryExecution().analyzed().collectLeaves().mkString()
        assert "_range" in cut
        ranges = rows.repartitionByRange(*(F.col(c) for c in keys), *order)
        sizes = ranges.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"))
        assert sizes.agg(F.max("rows")).first()[0] < 2 * 30_000 / sizes.count()


def test_numbers_of_nothing(skewed):
    assert number_sorted(skewed.limit(0), ["key"], ["position"], "n").collect() == []


@pytest.mark.parametrize("most", [5, 100_000])
def test_small_groups_are_numbered_whole_and_large_ones_in_buckets(spark, monkeypatch, most):
    monkeypatch.setattr(numbering, "GROUP_ROWS", most)
    i = F.col("id")
    rows = spark.range(400).select(
        F.when(i % 2 == 0, 0).when(i % 101 != 3, i % 90).alias("key"), (i * 7 % 400).alias("at")
    )
    rows = durable(rows.union(rows.limit(1).select("key", F.lit(None).cast("bigint"))))
    got = number_groups(rows, ["key"], ["at"], [F.shiftright("at", 5)], "n", "size")
    window = Window.partitionBy("key")
    want = rows.withColumns(
        {
            "n": F.row_number().over(window.orderBy("at")).cast("bigint"),
            "size": F.count("*").over(window),
        }
    ).dropna()
    assert got.dtypes == want.dtypes
    assert sorted(got.collect()) == sorted(want.collect())


def test_small_groups_take_one_shuffle_of_the_rows(spark):
    rows = durable(spark.range(1000).select((F.col("id") % 300).alias("key"), F.col("id").alias("at")))
    plan = number_groups(rows, ["key"], ["at"], [F.shiftright("at", 5)], "n", "size")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
