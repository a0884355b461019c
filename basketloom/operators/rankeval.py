"""Quality of recommendation lists against the next order."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.functions.ranking import (
    ideal_gain,
    ndcg_at_k,
    precision_at_k,
    rank_gain,
    recall_at_k,
)

#: Lists that become rows in one task.
LISTS = 20_000


def user_metrics(
    predicted: DataFrame, truth: DataFrame, k: int = 10, users: str = "common"
) -> DataFrame:
    """Metrics per user: ``DF[user_id, hits, n_actual, precision, recall, ndcg]``.

    ``predicted`` is ``DF[user_id, predicted: array]`` with one row per user,
    ``truth`` is ``DF[user_id, product_id]``. ``users="common"`` keeps users that
    have both; ``"truth"`` keeps every user with a truth and counts a missing
    list as empty, so that models are compared on the same users.

    Both sides become rows and are counted together, first per (user, product),
    then per user. There is no join, each step combines before it shuffles, and
    nobody's next order has to fit into one array. The lists are counted first, so they
    should be a table or cheap to make.
    """
    if users not in ("common", "truth"):
        raise ValueError("users must be 'common' or 'truth'")
    # Users are few bytes, so AQE puts very many in a task; as rows their lists are k times that.
    # Their number tells the tasks: each writes a file per task of the next shuffle.
    # Dealt by both columns: Spark leaves out a shuffle by the user alone that follows another.
    cores = predicted.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, -(-predicted.count() // LISTS))
    ranks = predicted.repartition(parts, "user_id", "predicted").select(
        "user_id", F.posexplode_outer(F.slice("predicted", 1, k)).alias("_at", "product_id")
    ).select(
        "user_id",
        "product_id",
        (F.col("_at") + 1).alias("rank"),
        F.lit(1).alias("listed"),
        F.lit(0).alias("actual"),
    )
    facts = truth.select(
        "user_id",
        "product_id",
        F.lit(None).cast("int").alias("rank"),
        F.lit(0).alias("listed"),
        F.lit(1).alias("actual"),
    )
    pairs = ranks.unionByName(facts).groupBy("user_id", "product_id").agg(
        F.min("rank").alias("rank"), F.max("listed").alias("listed"), F.max("actual").alias("actual")
    )
    hit = (F.col("actual") == 1) & F.col("rank").isNotNull()
    per_user = pairs.groupBy("user_id").agg(
        F.max("listed").alias("listed"),
        F.sum("actual").alias("n_actual"),
        F.count_if(hit).alias("hits"),
        F.sum(F.when(hit, rank_gain(F.col("rank"))).otherwise(0.0)).alias("gain"),
    )
    judged = per_user.where(F.col("n_actual") > 0)
    if users == "common":
        judged = judged.where(F.col("listed") == 1)
    return judged.select(
        "user_id",
        "hits",
        "n_actual",
        (F.col("hits") / F.lit(float(k))).alias("precision"),
        (F.col("hits") / F.col("n_actual")).alias("recall"),
        (F.col("gain") / ideal_gain(F.col("n_actual"), k)).alias("ndcg"),
    )


def ranking_metrics(
    predicted: DataFrame, truth: DataFrame, k: int = 10, users: str = "common"
) -> DataFrame:
    """Means over users: ``DF[n_users, precision, recall, ndcg]``."""
    return user_metrics(predicted, truth, k, users).agg(
        F.count("*").alias("n_users"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("ndcg").alias("ndcg"),
    )


def array_metrics(
    predicted: DataFrame, truth: DataFrame, k: int = 10, users: str = "common"
) -> DataFrame:
    """:func:`ranking_metrics` another way: each list against the array of the user's truth.

    Nothing is shared with the counting of rows, so equal results say something of
    both. A user's next order has to fit into one row here.
    """
    if users not in ("common", "truth"):
        raise ValueError("users must be 'common' or 'truth'")
    actual = truth.groupBy("user_id").agg(F.collect_set("product_id").alias("actual"))
    how = "inner" if users == "common" else "left"
    both = actual.join(predicted.select("user_id", "predicted"), "user_id", how).withColumn(
        "predicted", F.coalesce("predicted", F.array().cast("array<bigint>"))
    )
    pair = F.col("predicted"), F.col("actual")
    return both.agg(
        F.count("*").alias("n_users"),
        F.avg(precision_at_k(*pair, k)).alias("precision"),
        F.avg(recall_at_k(*pair, k)).alias("recall"),
        F.avg(ndcg_at_k(*pair, k)).alias("ndcg"),
    )


def metric_gap(one: DataFrame, other: DataFrame) -> DataFrame:
    """``DF[n_users, gap]`` of two rows of metrics: the largest difference of any, users too.

    A null in only one of them is a difference of 1, as a rate that is not there.
    """
    names = ["n_users", "precision", "recall", "ndcg"]
    both = one.select(F.struct(*names).alias("a")).withColumn(
        "b", other.select(F.struct(*names)).scalar()
    )

    def difference(name: str) -> Column:
        a, b = F.col(f"a.{name}"), F.col(f"b.{name}")
        return F.when(a.isNull() & b.isNull(), 0.0).otherwise(F.coalesce(F.abs(a - b), F.lit(1.0)))

    return both.select(
        F.col("a.n_users").alias("n_users"), F.greatest(*map(difference, names)).alias("gap")
    )


def compare_models(metrics: Mapping[str, DataFrame]) -> DataFrame:
    """One row per model: ``DF[model, n_users, precision, recall, ndcg]``."""
    rows = [df.select(F.lit(name).alias("model"), "*") for name, df in metrics.items()]
    return reduce(DataFrame.unionByName, rows)
