"""Statistics of the data set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.operators.names import with_product_names
from basketloom.sources.tables import Tables


def table_counts(tables: Tables) -> DataFrame:
    """Rows of each table: ``DF[table_name, n_rows]``."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.named().items()
    ]
    return reduce(DataFrame.unionAll, counts)


def _order_facts(orders: DataFrame) -> DataFrame:
    """One row: orders and users. A null user counts as one user."""
    per_user = orders.groupBy("user_id").agg(F.count("*").alias("n"))
    return per_user.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orders"), F.count("*").alias("users"))


def _line_facts(prior: DataFrame) -> DataFrame:
    """One row: lines, share of reordered lines and mean lines of orders having any.

    All three follow from the per-order sums, so the lines are read once.
    """
    per_order = prior.groupBy("order_id").agg(
        F.count("*").alias("n"),
        F.sum("reordered").alias("again"),
        F.count("reordered").alias("marked"),
    )
    return per_order.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("interactions"),
        (F.try_divide(F.sum("again"), F.sum("marked")) * 100).alias("reorder_rate"),
        F.try_divide(F.sum("n"), F.count("*")).alias("basket"),
    )


def unique_users(orders: DataFrame) -> DataFrame:
    """``DF[users]``; a null user counts as one user."""
    return _order_facts(orders).select("users")


def avg_basket(prior: DataFrame) -> DataFrame:
    """Mean lines per order over orders that have lines: ``DF[basket]``."""
    return _line_facts(prior).select("basket")


def reorder_rate(prior: DataFrame) -> DataFrame:
    """Percentage of lines that repeat an earlier purchase: ``DF[reorder_rate]``."""
    return prior.agg((F.avg("reordered") * 100).alias("reorder_rate"))


def dashboard_stats(tables: Tables) -> DataFrame:
    """One row: orders, users, products, interactions, reorder rate (%) and basket size."""
    parts = [
        _order_facts(tables.orders),
        tables.products.agg(F.count("*").alias("products")),
        _line_facts(tables.prior),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(
        *[F.max(c).alias(c) for c in ("orders", "users", "products", "interactions")],
        *[F.round(F.max(c), 2).alias(c) for c in ("reorder_rate", "basket")],
    )


def _histogram(orders: DataFrame, column: str, values: int) -> DataFrame:
    counts = orders.groupBy(column).agg(F.count("*").alias("n"))
    slots = orders.sparkSession.range(0, values, 1, 1).select(F.col("id").cast("int").alias(column))
    return slots.join(counts, column, "left").select(
        column, F.coalesce("n", F.lit(0)).alias("n_orders")
    )


def orders_by_hour(orders: DataFrame) -> DataFrame:
    """Orders per hour, 24 rows, hours without orders at 0."""
    return _histogram(orders, "order_hour_of_day", 24)


def orders_by_dow(orders: DataFrame) -> DataFrame:
    """Orders per day of week, 7 rows, days without orders at 0."""
    return _histogram(orders, "order_dow", 7)


def product_counts(lines: DataFrame) -> DataFrame:
    """Lines per product: ``DF[product_id, n]``."""
    return lines.groupBy("product_id").agg(F.count("*").alias("n"))


def by_count(count: str = "n") -> list[Column]:
    """Most frequent first, the smaller product id on ties."""
    return [F.desc(count), F.asc("product_id")]


def top_products(counts: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most bought known products: ``DF[product_id, product_name, n]``.

    ``counts`` is ``DF[product_id, n]``. Names are joined before sorting, since a
    join does not keep an order; the ``k`` rows are then taken without a full sort.
    """
    named = with_product_names(counts, products)
    return named.select("product_id", "product_name", "n").orderBy(*by_count()).limit(k)
