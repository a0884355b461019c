"""Customer profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.functions.numbering import task_count
from basketloom.operators.history import history, orders_in, restrict, user_products
from basketloom.sources.tables import Tables


def favourite_counts(
    df: DataFrame, dimensions: Sequence[str], measures: Sequence[Column]
) -> DataFrame:
    """Measures per (user, dimension value) for several dimensions in one aggregation.

    The column ``_no_<dimension>`` is 0 in the rows of that dimension.
    """
    sets = [[F.col("user_id"), F.col(d)] for d in dimensions]
    flags = [F.grouping(d).alias(f"_no_{d}") for d in dimensions]
    return df.groupingSets(sets, "user_id", *dimensions).agg(*measures, *flags)


def _favourite(dimension: str, count: str) -> Column:
    """Struct of the highest count and its value; the smaller value on ties."""
    pair = F.struct(F.col(count).alias("n"), (-F.col(dimension)).alias("_negative"))
    best = F.max(F.when((F.col(f"_no_{dimension}") == 0) & (F.col(count) > 0), pair))
    return F.struct(best["n"].alias("n"), (-best["_negative"]).alias("value"))


def _percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 1)


def basic_customer_aggs(pairs: DataFrame) -> DataFrame:
    """Lines, distinct products and reorder rate per user, from ``user_products``."""
    return pairs.groupBy("user_id").agg(
        F.sum("purchases").alias("purchases"),
        F.count("product_id").alias("unique_products"),
        F.try_divide(F.sum("reorders"), F.sum("marked")).alias("reorder_rate"),
    )


def _order_habits(orders: DataFrame) -> DataFrame:
    """Orders, favourite day and favourite hour of each user."""
    counts = favourite_counts(
        orders, ["order_dow", "order_hour_of_day"], [F.count("*").alias("n")]
    )
    return counts.groupBy("user_id").agg(
        F.sum(F.when(F.col("_no_order_dow") == 0, F.col("n"))).alias("orders"),
        _favourite("order_dow", "n").alias("day"),
        _favourite("order_hour_of_day", "n").alias("hour"),
    )


def _line_habits(pairs: DataFrame, products: DataFrame, tasks: int) -> DataFrame:
    """Purchases, distinct products, reorder rate and favourite aisle and department.

    Every product belongs to one aisle row of its user, so the aisle rows also
    add up to the totals. Unknown products have no aisle: they count in the
    totals but not for a favourite.
    """
    places = products.select(
        "product_id", "aisle_id", "department_id", F.lit(True).alias("_known")
    )
    known = F.when(F.col("_known"), F.col("purchases")).otherwise(0)
    measures = [
        F.col("purchases").alias("n"),
        known.alias("n_known"),
        F.col("product_id").isNotNull().cast("bigint").alias("n_products"),
        "reorders",
        "marked",
    ]
    # All that is asked of a user is counted where the user's pairs are, a bounded
    # number of them in a task: a count per place before the shuffle combines little.
    dealt = (
        pairs.join(places, "product_id", "left")
        .select("user_id", "aisle_id", "department_id", *measures)
        .repartition(tasks, "user_id")
    )
    names = ["n", "n_known", "n_products", "reorders", "marked"]
    sides = F.array(
        *(
            F.struct(
                F.lit(no_aisle).alias("_no_aisle_id"),
                F.lit(1 - no_aisle).alias("_no_department_id"),
                F.when(F.lit(no_aisle) == 0, F.col("aisle_id")).alias("aisle_id"),
                F.when(F.lit(no_aisle) == 1, F.col("department_id")).alias("department_id"),
            )
            for no_aisle in (0, 1)
        )
    )
    keys = ["_no_aisle_id", "_no_department_id", "aisle_id", "department_id"]
    counts = (
        dealt.select("user_id", *names, F.explode(sides).alias("_side"))
        .select("user_id", *names, *(F.col(f"_side.{k}").alias(k) for k in keys))
        .groupBy("user_id", *keys)
        .agg(*(F.sum(c).alias(c) for c in names))
    )
    once = F.col("_no_aisle_id") == 0
    total = {c: F.sum(F.when(once, F.col(c))) for c in ("n", "n_products", "reorders", "marked")}
    return counts.groupBy("user_id").agg(
        total["n"].alias("purchases"),
        total["n_products"].alias("unique_products"),
        F.try_divide(total["reorders"], total["marked"]).alias("reorder_rate"),
        _favourite("aisle_id", "n_known").alias("aisle_top"),
        _favourite("department_id", "n_known").alias("department_top"),
    )


def customer_profile(
    tables: Tables, users: DataFrame | None = None, pairs: DataFrame | None = None
) -> DataFrame:
    """One row per user with prior orders: sizes, reorder rate and favourites with shares.

    Shares of aisle and department are of all lines, those of day and hour of
    all orders. Without a known favourite the name is ``Unknown`` and the share null.
    ``pairs`` are the ``user_products`` of the prior lines, where they exist already.
    """
    orders = orders_in(tables.orders, "prior", users=users)
    if pairs is None:
        pairs = user_products(history(tables.prior, orders))
    else:
        pairs = restrict(pairs, users)
    habits = _order_habits(orders).join(
        _line_habits(pairs, tables.products, task_count(tables.prior)), "user_id", "left"
    )
    flat = habits.select(
        "*",
        F.col("aisle_top.value").alias("aisle_id"),
        F.col("department_top.value").alias("department_id"),
    )
    named = flat.join(tables.aisles.select("aisle_id", "aisle"), "aisle_id", "left").join(
        tables.departments.select("department_id", "department"), "department_id", "left"
    )
    known_aisle = F.when(F.col("aisle").isNotNull(), F.col("aisle_top.n"))
    known_department = F.when(F.col("department").isNotNull(), F.col("department_top.n"))
    return named.select(
        "user_id",
        "orders",
        F.coalesce("unique_products", F.lit(0)).alias("unique_products"),
        F.coalesce("purchases", F.lit(0)).alias("purchases"),
        F.round(F.col("reorder_rate") * 100, 1).alias("reorder_rate"),
        F.coalesce("department", F.lit("Unknown")).alias("favorite_department"),
        F.coalesce("aisle", F.lit("Unknown")).alias("favorite_aisle"),
        _percent(known_department, F.col("purchases")).alias("favorite_department_share"),
        _percent(known_aisle, F.col("purchases")).alias("favorite_aisle_share"),
        F.col("day.value").alias("favorite_order_day"),
        _percent(F.col("day.n"), F.col("orders")).alias("favorite_order_day_share"),
        F.col("hour.value").alias("favorite_order_hour"),
        _percent(F.col("hour.n"), F.col("orders")).alias("favorite_order_hour_share"),
    )
