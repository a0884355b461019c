"""Longer jobs that fit models to choose between settings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.operators.als import GRID, tune_als
from basketloom.operators.history import leave_last_order_out, orders_in
from basketloom.sources.durable import durable
from basketloom.sources.tables import Tables


def tune_on_last_order(
    tables: Tables,
    grid: Sequence[tuple[int, float]] = tuple(GRID),
    k: int = 10,
    max_user_id: int | None = None,
    recounted: bool = False,
) -> DataFrame:
    """Metrics of ALS settings, fitted without each user's last prior order and judged on it.

    Only users with a next order take part. The lines are joined to their orders
    once and counted per split. ``recounted`` as for ``tune_als``.
    """
    labelled = orders_in(tables.orders, "train", max_user_id)
    orders = leave_last_order_out(
        orders_in(tables.orders, "prior", max_user_id, users=labelled)
    )
    held = F.col("split") == "validation"
    lines = tables.prior.join(orders.select("order_id", "user_id", "split"), "order_id")
    pairs = durable(
        lines.groupBy("user_id", "product_id").agg(
            F.count_if(~held).alias("purchases"), F.count_if(held).alias("held")
        ),
        "tuning",
    )
    return tune_als(
        pairs.where(F.col("purchases") > 0).select("user_id", "product_id", "purchases"),
        pairs.where(F.col("held") > 0).select("user_id", "product_id"),
        grid,
        k,
        recounted=recounted,
    )
