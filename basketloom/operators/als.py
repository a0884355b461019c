"""Recommendations by matrix factorisation of purchase counts."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.functions.numbering import dense_ids
from basketloom.operators.rankeval import array_metrics, ranking_metrics
from basketloom.operators.recommend import rows_as_lists
from basketloom.operators.topk import search_best
from basketloom.sources.durable import durable

# The model's settings and the settings tried in tuning.
RANK = 20
REG = 0.1
ALPHA = 10.0
ITERATIONS = 5
SEED = 42
BLOCKS = 16
GRID = [(5, 0.05), (5, 0.10), (10, 0.05), (10, 0.10), (20, 0.05), (20, 0.10)]


def fit_als(
    interactions: DataFrame,
    rank: int = RANK,
    reg: float = REG,
    alpha: float = ALPHA,
    iterations: int = ITERATIONS,
    seed: int = SEED,
    blocks: int = BLOCKS,
) -> ALSModel:
    """Implicit-feedback ALS on ``DF[user_id, product_id, purchases]``.

    ``blocks`` bounds the tasks of one step. It is a setting of the model, not of
    the cluster, as the sums in a block depend on it; rows are placed by user and
    sorted, so the same rows give the same model. All ratings of a product meet in
    one block. Factors are checkpointed in between where the session has a
    checkpoint folder. Ids must fit 32 bits; see :func:`index_ids`.
    """
    rows = interactions.select("user_id", "product_id", "purchases")
    rows = rows.repartition(blocks, "user_id").sortWithinPartitions("user_id", "product_id")
    als = ALS(
        userCol="user_id",
        itemCol="product_id",
        ratingCol="purchases",
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        implicitPrefs=True,
        alpha=alpha,
        coldStartStrategy="drop",
        nonnegative=True,
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=2,
    )
    return als.fit(rows)


def index_ids(interactions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Interactions with dense ids, and what each dense user and product id stands for."""
    users = durable(dense_ids(interactions, "user_id"), "user-ids")
    products = durable(dense_ids(interactions, "product_id"), "product-ids")
    indexed = (
        interactions.join(users.withColumnRenamed("dense_id", "_user"), "user_id")
        .join(products.withColumnRenamed("dense_id", "_product"), "product_id")
        .select(F.col("_user").alias("user_id"), F.col("_product").alias("product_id"), "purchases")
    )
    return indexed, users, products


def restore_ids(rows: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Recommendations in dense ids back to the ids of :func:`index_ids`."""
    dense = rows.withColumnsRenamed({"user_id": "_user", "product_id": "_product"})
    return (
        dense.join(users.withColumnRenamed("dense_id", "_user"), "_user")
        .join(products.withColumnRenamed("dense_id", "_product"), "_product")
        .select("user_id", "product_id", "rank", "score")
    )


def recommend(model: ALSModel, k: int = 10, users: DataFrame | None = None) -> DataFrame:
    """Best ``k`` products, bought before or not: ``DF[user_id, product_id, rank, score]``.

    For every user of the model, or for the given ones; a user the model does
    not know has no rows. All users are searched with bounds (``search_best``), a few
    are scored with all products.
    """
    if users is None:
        return search_best(model.userFactors, model.itemFactors, model.rank, k).rows
    lists = model.recommendForUserSubset(users.select("user_id").distinct(), k)
    rows = lists.select("user_id", F.posexplode("recommendations").alias("at", "item"))
    return rows.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("item.product_id").cast("bigint").alias("product_id"),
        (F.col("at") + 1).alias("rank"),
        F.col("item.rating").cast("double").alias("score"),
    )


def recommend_known(
    model: ALSModel,
    ids: tuple[DataFrame, DataFrame],
    k: int = 10,
    users: DataFrame | None = None,
) -> DataFrame:
    """:func:`recommend` of a model fitted on :func:`index_ids`, in and out in real ids."""
    if users is not None:
        users = users.select("user_id").distinct().join(ids[0], "user_id").select(
            F.col("dense_id").alias("user_id")
        )
    return restore_ids(recommend(model, k, users), *ids)


def novel(model: ALSModel, interactions: DataFrame, k: int = 10) -> DataFrame:
    """The best ``k`` products each user of ``interactions`` has not bought.

    What a user bought is left out while products are searched (``search_best``), so
    a list is filled however much that is.
    """
    bought = interactions.select("user_id", "product_id").distinct()
    asking = durable(
        model.userFactors.join(bought.select(F.col("user_id").alias("id")), "id", "left_semi"),
        "asking",
    )
    return search_best(asking, model.itemFactors, model.rank, k, without=bought).rows


def recommended_lists(model: ALSModel, k: int = 10, users: DataFrame | None = None) -> DataFrame:
    """The same as lists of ids: ``DF[user_id, predicted: array]``.

    Given users are searched as all users are: the model's own scoring makes a row for
    every product of a block, and as many tasks as blocks of users times those of products.
    """
    asking = model.userFactors
    if users is not None:
        known = users.select(F.col("user_id").alias("id"))
        asking = durable(asking.join(known, "id", "left_semi"), "asking")
    return rows_as_lists(search_best(asking, model.itemFactors, model.rank, k).rows)


def tune_als(
    interactions: DataFrame,
    truth: DataFrame,
    grid: Sequence[tuple[int, float]] = tuple(GRID),
    k: int = 10,
    parallelism: int = 3,
    recounted: bool = False,
) -> DataFrame:
    """Metrics of each (rank, reg), best NDCG first and the earlier setting on ties.

    ``DF[position, rank, reg, n_users, precision, recall, ndcg]``. Every setting
    reads the inputs again: make them durable first. ``parallelism`` settings are
    fitted at a time; one row per setting comes back to the driver.

    With ``recounted`` each setting's lists are kept and judged a second way (see
    ``array_metrics``); the column ``gap`` is the largest difference of any metric.
    """
    spark = interactions.sparkSession
    users = durable(truth.select("user_id").distinct(), "users")

    def judge(setting: tuple[int, float]) -> tuple:
        rank, reg = setting
        model = fit_als(interactions, rank=rank, reg=reg)
        lists = durable(recommended_lists(model, k, users), "lists")
        row = ranking_metrics(lists, truth, k).first()
        if not recounted:
            return tuple(row)
        again = array_metrics(lists, truth, k).first()
        return *row, max(
            0.0 if a is b is None else 1.0 if a is None or b is None else abs(float(a - b))
            for a, b in zip(row, again)
        )

    with ThreadPool(parallelism) as pool:
        metrics = pool.map(inheritable_thread_target(spark)(judge), grid, chunksize=1)
    rows = spark.createDataFrame(
        [(i, *setting, *row) for i, (setting, row) in enumerate(zip(grid, metrics))],
        "position int, rank int, reg double, n_users bigint,"
        " precision double, recall double, ndcg double" + ", gap double" * recounted,
    )
    return rows.orderBy(F.desc("ndcg"), F.asc("position"))
