"""Recommending what most people buy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.functions.numbering import number_sorted
from basketloom.operators.recommend import novel_recommendations
from basketloom.operators.stats import by_count, product_counts, top_products
from basketloom.sources.durable import durable
from basketloom.sources.tables import Tables


def popularity_table(tables: Tables, k: int = 100) -> DataFrame:
    """The ``k`` most bought products with their counts."""
    return top_products(product_counts(tables.prior), tables.products, k)


def popular_list(counts: DataFrame, k: int = 10) -> DataFrame:
    """One row ``DF[predicted: array]``: the ``k`` most bought product ids, best first.

    ``counts`` is ``DF[product_id, n]``.
    """
    best = counts.orderBy(*by_count()).limit(k)
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "product_id")))
    return best.agg(F.transform(ranked, lambda r: r["product_id"]).alias("predicted"))


def popular_ranks(counts: DataFrame) -> DataFrame:
    """All products from the most bought on: ``DF[product_id, pop_rank]``.

    Sorted in ranges of count and id, so no task sorts all products nor all of one
    count, of which the small ones have very many.
    """
    known = counts.where(F.col("n").isNotNull() & F.col("product_id").isNotNull())
    ranked = number_sorted(known, [], [F.desc("n"), "product_id"], "pop_rank")
    return ranked.select("product_id", "pop_rank")


def novel_popular(
    counts: DataFrame, users: DataFrame, interactions: DataFrame, k: int = 10
) -> DataFrame:
    """The ``k`` most bought products that a user has not bought: ``DF[user_id, product_id, rank]``.

    A user who bought b products needs the first k + b at most, so these are made
    for each user and joined by rank: no list is cut short, and rows are in
    proportion to users and purchases.
    """
    bought = interactions.select("user_id", "product_id").distinct()
    many = bought.groupBy("user_id").agg(F.count("*").alias("b"))
    asked = users.select("user_id").distinct().join(many, "user_id", "left").select(
        "user_id",
        F.explode(F.sequence(F.lit(1), F.lit(k) + F.coalesce("b", F.lit(0)).cast("int"))).alias("pop_rank"),
    )
    ranks = durable(popular_ranks(counts), "ranks")
    rows = asked.join(ranks, "pop_rank").select(
        "user_id", "product_id", F.col("pop_rank").alias("rank")
    )
    return novel_recommendations(rows, bought, k)


def popularity_recommendations(counts: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """The same ``k`` products for every user: ``DF[user_id, predicted: array]``.

    The list is a scalar subquery, computed once and added to the users as a
    constant: no join and no shuffle of the users.
    """
    return users.select("user_id", popular_list(counts, k).scalar().alias("predicted"))
