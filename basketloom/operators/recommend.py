"""Working with recommendation lists: ``DF[user_id, predicted: array]`` or scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketloom.operators.names import with_product_names


def list_rows(predicted: DataFrame) -> DataFrame:
    """Lists as rows: ``DF[user_id, product_id, rank]``, ranks from 1."""
    # Outer, then without the empty lists: the plain form filters on the size of
    # the list first, which computes a list that is a subquery twice.
    rows = predicted.select("user_id", F.posexplode_outer("predicted").alias("at", "product_id"))
    return rows.where(F.col("at").isNotNull()).select(
        "user_id", "product_id", (F.col("at") + 1).alias("rank")
    )


def rows_as_lists(rows: DataFrame) -> DataFrame:
    """The reverse of :func:`list_rows`, for the at most ``k`` ranked rows of each user."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "product_id")))
    return rows.groupBy("user_id").agg(
        F.transform(ranked, lambda row: row["product_id"]).alias("predicted")
    )


def topk_per_user(
    df: DataFrame, order_by: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each user, numbered from 1.

    Spark keeps only ``k`` rows per user and task before it shuffles
    (``WindowGroupLimit``), so a user with very many rows is no single task's load.
    """
    numbered = F.row_number().over(Window.partitionBy("user_id").orderBy(*order_by))
    return df.withColumn(rank, numbered).where(F.col(rank) <= k)


def novel_recommendations(rows: DataFrame, interactions: DataFrame, k: int = 10) -> DataFrame:
    """Drop products a user has already bought, keep the best ``k`` left and rank them anew.

    ``rows`` is ``DF[user_id, product_id, rank, ...]``.
    """
    bought = interactions.select("user_id", "product_id")
    fresh = rows.join(bought, ["user_id", "product_id"], "left_anti")
    return topk_per_user(
        fresh.withColumnRenamed("rank", "_asked"), [F.asc("_asked"), F.asc("product_id")], k
    ).drop("_asked")


def recommend_named(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Names and scores at 4 decimals: ``DF[user_id, rank, product_id, product_name, score]``."""
    return with_product_names(rows, products, "left").select(
        "user_id", "rank", "product_id", "product_name", F.round("score", 4).alias("score")
    )
