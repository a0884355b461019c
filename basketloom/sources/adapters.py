"""The six tables derived from general sales and event tables, written once.

Deriving them numbers every order and line, which every query would repeat. So
the result is written to a folder all executors share, and queries read that.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketloom.functions.numbering import (
    large_groups,
    number_groups,
    number_rows,
    task_count,
)
from basketloom.sources.durable import durable
from basketloom.sources.schemas import AISLES, DEPARTMENTS, ORDERS, PRODUCTS
from basketloom.sources.tables import Tables, table_path, write_table

# Widths of the numbering buckets (see number_rows) as powers of two: a group is
# cut where the ordering column passes a multiple of the width.
PRODUCT_BUCKET_BITS = 12
EVENT_BUCKET_BITS = 17
# Order numbers of a user that are looked at together, as a power of two.
SPAN_BITS = 17


def _read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet")


def _stored(df: DataFrame, path: str, name: str) -> DataFrame:
    """Write a table and go on with what was written."""
    location = table_path(path, name, "parquet")
    write_table(df, location)
    return df.sparkSession.read.schema(df.schema).parquet(location)


def _as(df: DataFrame, schema) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType) for f in schema])


def _eval_set() -> Column:
    """A user's last order is the next order to predict; every fifth user's is held back."""
    return (
        F.when(F.col("order_number") < F.col("_n"), "prior")
        .when(F.col("user_id") % 5 == 0, "test")
        .otherwise("train")
    )


def _baskets(lines: DataFrame) -> DataFrame:
    """One row per (order, product), at its first position."""
    return lines.groupBy("order_id", "product_id").agg(F.min("_position").alias("_position"))


def _placed(
    lines: DataFrame, header: DataFrame, order_by: list[str], buckets: list[Column]
) -> DataFrame:
    """Baskets with their order, numbered within it; of an order that repeats, the earlier first.

    The lines are shuffled once, by order: baskets, header and numbers need no other
    place. Only orders of very many lines are spread by product and cut into buckets.
    """
    large = large_groups(lines, ["order_id"])
    usual = lines if large is None else lines.join(large, "order_id", "left_anti")
    usual = usual.dropna(subset=["order_id"]).repartition(task_count(lines), "order_id")
    order_by = [*order_by, "order_number"]
    number = F.row_number().over(Window.partitionBy("order_id").orderBy(*order_by))
    placed = (
        _baskets(usual)
        .join(header, "order_id")
        .withColumn("add_to_cart_order", number.cast("bigint"))
    )
    if large is None:
        return placed
    cut = durable(_baskets(lines.join(large, "order_id", "left_semi")).join(header, "order_id"))
    # A row without a bucket has no number, but may be the first purchase all the same.
    numbered = number_rows(cut, ["order_id"], order_by, buckets, "add_to_cart_order")
    left_out = cut.where(reduce(or_, [b.isNull() for b in buckets]))
    return placed.unionByName(numbered).unionByName(left_out, allowMissingColumns=True)


def _reordered(placed: DataFrame, orders: DataFrame, tasks: int) -> DataFrame:
    """Add ``reordered``: 1 unless the order is the user's first with the product.

    One shuffle by user, product and span, a stretch of ``2 ** SPAN_BITS`` order numbers,
    so that a product bought in very many orders is not sorted in one task. Users that
    have a second span also need to know in which one a product came first.
    """
    pair = ["user_id", "product_id"]
    spans = placed.withColumn("_span", F.shiftright("order_number", SPAN_BITS))
    busy = orders.where(F.col("order_number") >= 1 << SPAN_BITS).select("user_id").distinct()
    first = None
    if not busy.isEmpty():
        spans = durable(spans, "placed")
        first = (
            spans.join(F.broadcast(busy), "user_id", "left_semi")
            .groupBy(*pair)
            .agg(F.min("_span").alias("_span"))
            .withColumn("_first", F.lit(True))
        )
    earliest = Window.partitionBy(*pair, "_span").orderBy("order_number")
    dealt = spans.repartition(tasks, *pair, "_span").withColumn(
        "_again", F.row_number().over(earliest) > 1
    )
    again = F.col("_again") | F.col("product_id").isNull()
    if first is not None:
        dealt = dealt.join(first, [*pair, "_span"], "left")
        again = again | ((F.col("_span") > 0) & F.col("_first").isNull())
    return dealt.withColumn("reordered", again.cast("int"))


def _store_lines(
    lines: DataFrame, orders: DataFrame, order_by: list[str], buckets: list[Column], path: str
) -> DataFrame:
    """Distinct (order, product) baskets to the line table, one folder per evaluation set."""
    header = orders.select("order_id", "user_id", "order_number", "eval_set")
    placed = _placed(lines, header, order_by, buckets)
    rows = _reordered(placed, orders, task_count(lines))
    for bucket in buckets:
        rows = rows.where(bucket.isNotNull())
    rows = rows.select(
        "order_id", "product_id", F.col("add_to_cart_order").cast("int"), "reordered", "eval_set"
    )
    location = table_path(path, "order_products", "parquet")
    rows.write.mode("overwrite").partitionBy("eval_set").parquet(location)
    return lines.sparkSession.read.schema(rows.schema).parquet(location)


def _ranked_names(part: DataFrame, column: str, id_name: str, name: str) -> DataFrame:
    # Over the distinct names of a closed list (25 brands, 6 types), not over parts.
    order = Window.partitionBy(F.lit(0)).orderBy(name)
    names = part.select(F.col(column).alias(name)).distinct()
    return names.select(F.row_number().over(order).alias(id_name), name)


def _store(
    spark: SparkSession,
    source: str,
    path: str,
    orders: DataFrame,
    lines: DataFrame,
    order_by: list[str],
    buckets: list[Column],
) -> Tables:
    part = _read(spark, source, "part")
    aisles = _stored(_as(_ranked_names(part, "p_brand", "aisle_id", "aisle"), AISLES), path, "aisles")
    departments = _stored(
        _as(_ranked_names(part, "p_type", "department_id", "department"), DEPARTMENTS),
        path,
        "departments",
    )
    products = (
        part.withColumnsRenamed(
            {"p_partkey": "product_id", "p_name": "product_name",
             "p_brand": "aisle", "p_type": "department"}
        )
        .join(aisles, "aisle")
        .join(departments, "department")
    )
    products = _stored(_as(products, PRODUCTS), path, "products")
    orders = _stored(_as(orders, ORDERS), path, "orders")
    lines = _store_lines(lines, orders, order_by, buckets, path)
    prior, train = (
        lines.where(F.col("eval_set") == s).drop("eval_set") for s in ("prior", "train")
    )
    return Tables(orders, prior, train, products, aisles, departments)


def store_sales(spark: SparkSession, source: str, path: str) -> Tables:
    """From ``orders``, ``lineitem`` and ``part``: many products, few repeats."""
    headers = _read(spark, source, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), "o_orderdate"
    )
    orders = number_groups(
        headers, ["user_id"], ["o_orderdate", "order_id"],
        [F.trunc("o_orderdate", "month")], "order_number", "_n",
    ).withColumns(
        {
            "eval_set": _eval_set(),
            "order_dow": F.dayofweek("o_orderdate") - 1,
            "order_hour_of_day": F.hour("o_orderdate"),
        }
    )
    lines = _read(spark, source, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("_position"),
    )
    buckets = [F.col("_position"), F.shiftright("product_id", PRODUCT_BUCKET_BITS)]
    return _store(spark, source, path, orders, lines, ["_position", "product_id"], buckets)


def store_events(spark: SparkSession, source: str, path: str) -> Tables:
    """From ``events`` and ``part``: few products, many repeats, all hours.

    One order per user and day, whose id holds both, the day as its number since 1970.
    """
    events = _read(spark, source, "events").select(
        "user_id",
        "event_id",
        "ts",
        F.to_date("ts").alias("_day"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
    )
    order_id = F.col("user_id") * 100000 + F.unix_date("_day")
    days = events.groupBy("user_id", "_day").agg(F.min("ts").alias("_start"))
    numbered = number_groups(
        durable(days, "days"), ["user_id"], ["_day"], [F.trunc("_day", "month")], "order_number", "_n"
    )
    orders = numbered.select(
        order_id.alias("order_id"),
        "user_id",
        "order_number",
        "_n",
        (F.dayofweek("_day") - 1).alias("order_dow"),
        F.hour("_start").alias("order_hour_of_day"),
    ).withColumn("eval_set", _eval_set())
    lines = events.select(
        order_id.alias("order_id"), "product_id", F.col("event_id").alias("_position")
    )
    buckets = [F.shiftright("_position", EVENT_BUCKET_BITS)]
    return _store(spark, source, path, orders, lines, ["_position"], buckets)


ADAPTERS: dict[str, Callable[[SparkSession, str, str], Tables]] = {
    "sales": store_sales,
    "events": store_events,
}
