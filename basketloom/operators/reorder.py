"""Which of the products bought before will a user buy again?"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.functions.splits import split_name
from basketloom.operators.history import (
    actual_sets,
    history,
    last_orders,
    orders_in,
    restrict,
    user_products,
)
from basketloom.operators.names import with_product_names
from basketloom.operators.recommend import topk_per_user
from basketloom.sources.tables import Tables

# The model's inputs in their order, its settings and serving threshold.
FEATURES = [
    "product_purchases",
    "first_order",
    "last_order",
    "avg_cart_position",
    "user_orders",
    "purchase_rate",
    "orders_since_last_purchase",
]
TREES = 50
DEPTH = 8
SEED = 42
PARTITIONS = 16
# Rows of one partition of the forest's input, where there are more than PARTITIONS of them.
PARTITION_ROWS = 100_000
THRESHOLD = 0.20

# Copies of a user's total, and parts of the user's products, in the join of both.
SALTS = 8


def _with_user_orders(pairs: DataFrame, orders: DataFrame) -> DataFrame:
    """Join each user's order total to the user's products.

    On the user alone, all products of one user would meet in one task. The
    product adds a salt to the key, and the narrow totals are copied per salt.
    Both inputs are then plain shuffles, which also lets AQE split what is still
    too large.
    """
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    totals = last_orders(orders).withColumn("_salt", F.explode(salts))
    salted = pairs.withColumn("_salt", F.pmod(F.hash("product_id"), F.lit(SALTS)))
    return salted.join(totals, ["user_id", "_salt"]).drop("_salt")


def _derived(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "purchase_rate": F.try_divide("product_purchases", "user_orders"),
            "orders_since_last_purchase": F.col("user_orders") - F.col("last_order"),
        }
    )


def reorder_features(
    orders: DataFrame,
    prior: DataFrame,
    max_user_id: int | None = None,
    users: DataFrame | None = None,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """The seven features of every (user, product) bought before; for training and serving.

    ``pairs`` are the ``user_products`` of the chosen users' prior lines, where
    they exist already.
    """
    if pairs is None:
        pairs = user_products(history(prior, orders_in(orders, "prior", max_user_id, users)))
    pairs = pairs.withColumnRenamed("purchases", "product_purchases")
    # The join keeps the users of the pairs, so the totals need no list of users.
    totals = orders_in(orders, "prior", max_user_id)
    return _derived(_with_user_orders(pairs, totals)).select(
        "user_id", "product_id", *FEATURES, *(c for c in ["label"] if c in pairs.columns)
    )


def reorder_dataset(
    orders: DataFrame,
    prior: DataFrame,
    train: DataFrame,
    labelled_only: bool = True,
    max_user_id: int | None = None,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Features and ``label``: 1.0 when the product is in the user's next order, else 0.0.

    With ``labelled_only`` users without a next order are left out; they could
    only have label 0. They are left out before the lines are joined, and the
    label is joined before the order totals, while the rows still are partitioned
    by (user, product). ``pairs`` as for :func:`reorder_features`.
    """
    users = orders_in(orders, "train", max_user_id) if labelled_only else None
    if pairs is None:
        pairs = user_products(history(prior, orders_in(orders, "prior", max_user_id, users)))
    else:
        pairs = restrict(pairs, users)
    truth = actual_sets(orders, train, max_user_id).withColumn("label", F.lit(1.0))
    labelled = pairs.join(truth, ["user_id", "product_id"], "left").fillna({"label": 0.0})
    return reorder_features(orders, prior, max_user_id, pairs=labelled)


def split_users(
    df: DataFrame, weights: Mapping[str, float] | None = None, seed: int = SEED
) -> DataFrame:
    """Add ``split`` by user, 80/20 into train and test unless given.

    All rows of a user get the same split without a join.
    """
    return df.withColumn("split", split_name("user_id", weights or {"train": 0.8, "test": 0.2}, seed))


def assemble(df: DataFrame) -> DataFrame:
    """Add the feature vector."""
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def fit_reorder(
    dataset: DataFrame,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    partitions: int | None = None,
    sampled: bool = True,
) -> RandomForestClassificationModel:
    """Random forest on a :func:`reorder_dataset` that was made durable.

    Trees sample rows by partition and place. So rows are dealt to a given number
    of ``partitions``, by default one that follows from their number, and sorted: the
    same rows give the same forest on any cluster.
    Without ``sampled`` every tree sees every row once and differs by its features only.
    """
    pair = ["user_id", "product_id"]
    if partitions is None:
        partitions = max(PARTITIONS, -(-dataset.count() // PARTITION_ROWS))
    dataset = dataset.repartition(partitions, *pair).sortWithinPartitions(*pair)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed,
        bootstrap=sampled,
    )
    return forest.fit(assemble(dataset))


def score_reorder(model: RandomForestClassificationModel, df: DataFrame) -> DataFrame:
    """Add ``probability`` of class 1 and the model's hard ``prediction``."""
    scored = model.transform(assemble(df))
    return scored.withColumn("probability", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction"
    )


def reorder_list(
    scored: DataFrame, products: DataFrame, threshold: float = THRESHOLD, k: int = 10
) -> DataFrame:
    """Up to ``k`` named products per user with probability at or above the threshold."""
    likely = with_product_names(scored.where(F.col("probability") >= threshold), products)
    best = topk_per_user(likely, [F.desc("probability"), F.asc("product_id")], k)
    return best.select(
        "user_id",
        "rank",
        "product_id",
        "product_name",
        F.round("probability", 4).alias("probability"),
        "product_purchases",
        F.round("purchase_rate", 4).alias("purchase_rate"),
        "orders_since_last_purchase",
        F.round("avg_cart_position", 2).alias("avg_cart_position"),
    )


def reorder_predictions(
    tables: Tables,
    model: RandomForestClassificationModel,
    threshold: float = THRESHOLD,
    k: int = 10,
    users: DataFrame | None = None,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """What each user will probably buy again, with the features that explain it."""
    features = reorder_features(tables.orders, tables.prior, users=users, pairs=pairs)
    return reorder_list(score_reorder(model, features), tables.products, threshold, k)
