"""A user, an order and a product each hold about a third of all lines.

Joins are forced to shuffle and AQE's sizes are lowered to those of a test, so
that it has to split the hot keys; results must be the same as without.
"""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from basketloom.operators import history, profile, recommend, reorder
from basketloom.sources.schemas import LINES, ORDERS, PRODUCTS
from basketloom.sources.tables import Tables

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "5KB",
}


@contextlib.contextmanager
def at_scale(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in SETTINGS:
            spark.conf.unset(key)


def cast(df, schema):
    return df.select([F.col(f.name).cast(f.dataType) for f in schema])


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    i = F.col("id")
    orders = spark.range(12_000).select(
        i.alias("order_id"),
        F.when(i % 3 == 0, 0).otherwise(1 + i % 200).alias("user_id"),
        F.when(i < 11_000, "prior").otherwise("train").alias("eval_set"),
        (1 + F.floor(i / 3)).alias("order_number"),
        (i % 7).alias("order_dow"),
        (i % 24).alias("order_hour_of_day"),
    )
    # A third of the lines is order 0 (of user 0); a third of the rest is product 0.
    lines = spark.range(90_000).select(
        F.when(i % 3 == 0, 0).otherwise(F.floor(i / 3) % 11_000).alias("order_id"),
        F.when(i % 3 == 0, i).when(i % 9 == 1, 0).otherwise(i % 977).alias("product_id"),
        (1 + i % 30).alias("add_to_cart_order"),
        (i % 2).alias("reordered"),
    )
    products = spark.range(100_000).select(
        i.alias("product_id"), F.concat(F.lit("p"), i).alias("product_name"),
        (i % 50).alias("aisle_id"), (i % 5).alias("department_id"),
    )
    aisles = spark.range(50).select(i.cast("int").alias("aisle_id"), F.concat(F.lit("a"), i).alias("aisle"))
    places = spark.range(5).select(
        i.cast("int").alias("department_id"), F.concat(F.lit("d"), i).alias("department")
    )
    path = str(tmp_path_factory.mktemp("skew"))
    made = {}
    for name, df, schema in [
        ("orders", orders, ORDERS), ("prior", lines, LINES), ("products", products, PRODUCTS)
    ]:
        cast(df, schema).repartition(8).write.parquet(f"{path}/{name}")
        made[name] = spark.read.schema(schema).parquet(f"{path}/{name}")
    train = spark.range(11_000, 12_000).select(
        i.alias("order_id"), (i % 977).alias("product_id"),
        F.lit(1).alias("add_to_cart_order"), F.lit(0).alias("reordered"),
    )
    return Tables(made["orders"], made["prior"], cast(train, LINES), made["products"], aisles, places)


QUERIES = {
    "interactions": lambda t: history.interactions(t.orders, t.prior),
    "purchase_history": history.purchase_history,
    "leave_last_order_out": lambda t: history.leave_last_order_out(
        history.orders_in(t.orders, "prior")
    ),
    "restricted": lambda t: history.orders_in(
        t.orders, "prior", users=history.orders_in(t.orders, "train")
    ),
    "features": lambda t: reorder.reorder_features(t.orders, t.prior),
    "dataset": lambda t: reorder.reorder_dataset(t.orders, t.prior, t.train),
    "profile": profile.customer_profile,
    "topk": lambda t: recommend.topk_per_user(
        history.interactions(t.orders, t.prior), [F.desc("purchases"), F.asc("product_id")], 10
    ),
}


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_with_hot_keys_split(spark, tables, name):
    plain = QUERIES[name](tables).collect()
    with at_scale(spark):
        split = QUERIES[name](tables).collect()
    assert sorted(map(str, plain)) == sorted(map(str, split))


@pytest.mark.parametrize(
    "name", ["interactions", "purchase_history", "restricted", "features", "dataset"]
)
def test_hot_keys_are_split(spark, tables, name):
    with at_scale(spark):
        plan = final_plan(QUERIES[name](tables))
    assert "skew=true" in plan


def test_order_totals_join_by_user_and_salt(spark, tables):
    """The join of features and order totals is one that AQE can split."""
    with at_scale(spark):
        plan = final_plan(QUERIES["features"](tables))
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert any("_salt" in line and "skew=true" in line for line in joins)
    assert not any("[user_id#" in line and "," not in line.split("]")[0] for line in joins)


def test_top_k_is_cut_before_the_shuffle(spark, tables):
    with at_scale(spark):
        plan = final_plan(QUERIES["topk"](tables))
    assert "WindowGroupLimit" in plan and "Partial" in plan
