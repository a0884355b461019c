"""A random forest as a table of nodes: its scores and its splits recomputed from rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.operators.reorder import FEATURES
from basketloom.sources.durable import durable, fresh_path

#: Differences that come from the order of summation.
TOLERANCE = 1e-9


@dataclass(frozen=True)
class Forest:
    """The nodes of all trees and the longest way down.

    ``nodes`` is ``DF[tree, node, feature, threshold, left, right, counts, impurity,
    gain]``: a row with at most ``threshold`` in its ``feature`` goes ``left``.
    ``counts`` has the training rows of either label; ``feature`` and both children
    are -1 in a leaf. Nodes of a tree are numbered from 0, the root.
    """

    nodes: DataFrame
    depth: int

    def beside(self, rows: DataFrame) -> DataFrame:
        """``rows`` with all trees as the value ``_trees``: an array per tree of its nodes.

        Its size is that of the model, at most ``2 ** (depth + 1)`` nodes a tree, which
        every task needs anyway to score a row.
        """
        node = F.struct("node", "feature", "threshold", "left", "right", "counts")
        trees = self.nodes.groupBy("tree").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
        every = trees.agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("trees"))
        return rows.withColumn("_trees", every.scalar())


def forest_table(model: RandomForestClassificationModel) -> Forest:
    """The nodes of a fitted or loaded model, from its saved form."""
    spark = SparkSession.active()
    path = fresh_path(spark, "forest")
    model.write().save(path)
    at = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        at["id"].alias("node"),
        at["split"]["featureIndex"].alias("feature"),
        F.get(at["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        at["leftChild"].alias("left"),
        at["rightChild"].alias("right"),
        at["impurityStats"].alias("counts"),
        at["impurity"].alias("impurity"),
        at["gain"].alias("gain"),
    )
    return Forest(nodes, max(tree.depth for tree in model.trees))


def _next(nodes: Column, values: Column, at: Column) -> Column:
    """Where a row goes on from node ``at``; a leaf is its own next."""
    node = F.get(nodes, at)
    goes_left = F.get(values, node["feature"]) <= node["threshold"]
    return F.when(node["left"] < 0, at).when(goes_left, node["left"]).otherwise(node["right"])


def _values() -> Column:
    return F.array(*(F.col(c).cast("double") for c in FEATURES))


def walk(forest: Forest, rows: DataFrame, name: str = "walked") -> DataFrame:
    """Add the probability of label 1 by the nodes: the mean share of a row's leaves."""
    steps = F.sequence(F.lit(1), F.lit(max(1, forest.depth)))
    values = _values()

    def share(tree: Column) -> Column:
        leaf = F.aggregate(steps, F.lit(0), lambda at, _: _next(tree["nodes"], values, at))
        counts = F.get(tree["nodes"], leaf)["counts"]
        # A forest that has only seen label 0 counts one label.
        ones = F.coalesce(F.get(counts, F.lit(1)), F.lit(0.0))
        return ones / (F.get(counts, F.lit(0)) + ones)

    shares = F.transform("_trees", share)
    total = F.aggregate(shares, F.lit(0.0), lambda s, x: s + x)
    return forest.beside(rows).withColumn(name, total / F.size("_trees")).drop("_trees")


def visits(forest: Forest, dataset: DataFrame) -> DataFrame:
    """Rows of either label that reach a node: ``DF[tree, node, n0, n1]``, all nodes reached.

    Every row goes down every tree; counts are combined before the shuffle, which has
    one row per task and node.
    """
    steps = F.sequence(F.lit(1), F.lit(max(1, forest.depth)))
    values = _values()

    def path(tree: Column) -> Column:
        ways = F.aggregate(
            steps,
            F.array(F.lit(0)),
            lambda way, _: F.when(
                F.get(tree["nodes"], F.element_at(way, -1))["left"] < 0, way
            ).otherwise(F.concat(way, F.array(_next(tree["nodes"], values, F.element_at(way, -1))))),
        )
        return F.struct(tree["tree"].alias("tree"), ways.alias("way"))

    rows = forest.beside(dataset).select("label", F.explode(F.transform("_trees", path)).alias("of"))
    steps_taken = rows.select("label", F.col("of.tree").alias("tree"), F.explode("of.way").alias("node"))
    return steps_taken.groupBy("tree", "node").agg(
        F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")
    )


def _gini(n0: Column, n1: Column) -> Column:
    total = n0 + n1
    return F.when(total > 0, 1 - F.pow(n0 / total, F.lit(2)) - F.pow(n1 / total, F.lit(2))).otherwise(0.0)


def fit_check(forest: Forest, dataset: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Is every node what its rows say? For a forest fitted on ``dataset`` without row sampling.

    ``DF[tree, n_rows, n_positive, n_nodes, wrong_counts, wrong_impurities, wrong_gains]``,
    one row per tree: rows and positive rows that reach the root, nodes, and how many
    of them have other counts, another impurity or another gain than recomputed. A
    node that no row reaches counts as wrong. A leaf that no feature could split has -1
    for its impurity, which says nothing.
    """
    reached = durable(visits(forest, dataset), "visits")
    counted = forest.nodes.join(reached, ["tree", "node"], "left").fillna(0, ["n0", "n1"])
    counted = counted.withColumn("gini", _gini(F.col("n0"), F.col("n1")))

    def child(side: str) -> DataFrame:
        return reached.select(
            "tree", F.col("node").alias(side),
            (F.col("n0") + F.col("n1")).alias(f"n_{side}"),
            _gini(F.col("n0"), F.col("n1")).alias(f"gini_{side}"),
        )

    both = counted.join(child("left"), ["tree", "left"], "left").join(
        child("right"), ["tree", "right"], "left"
    )
    n = F.col("n0") + F.col("n1")
    rest = sum((F.col(f"n_{s}") / n * F.col(f"gini_{s}") for s in ("left", "right")), F.lit(0.0))
    inner = F.col("left") >= 0

    def off(recorded: str, own: Column) -> Column:
        return ~F.coalesce(F.abs(F.col(recorded) - own) <= tolerance, F.lit(False))

    ones = F.coalesce(F.get("counts", F.lit(1)), F.lit(0.0))
    same = (n > 0) & (F.get("counts", F.lit(0)) == F.col("n0")) & (ones == F.col("n1"))
    root = F.col("node") == 0
    return both.groupBy("tree").agg(
        F.sum(F.when(root, n)).alias("n_rows"),
        F.sum(F.when(root, F.col("n1"))).alias("n_positive"),
        F.count("*").alias("n_nodes"),
        F.count_if(~F.coalesce(same, F.lit(False))).alias("wrong_counts"),
        F.count_if((inner | (F.col("impurity") != -1)) & off("impurity", F.col("gini"))).alias(
            "wrong_impurities"
        ),
        F.count_if(inner & off("gain", F.col("gini") - rest)).alias("wrong_gains"),
    )
