"""What holds for a fitted result whatever the fit is, so that SQL can state it too."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketloom.operators.names import with_product_names


def _count_if(test: Column, name: str) -> Column:
    return F.count_if(F.coalesce(test, F.lit(True))).alias(name)


def _rising(score: str) -> Column:
    """A row scored above the row before it in its user's list."""
    before = F.lag(score).over(Window.partitionBy("user_id").orderBy("rank"))
    return F.coalesce(F.col(score) > before, F.lit(False))


def in_bounds(*names: str) -> Column:
    """All the named rates are between 0 and 1."""
    test = F.lit(True)
    for name in names:
        test = test & F.col(name).between(0, 1)
    return F.coalesce(test, F.lit(False)).alias("in_bounds")


def factor_facts(model: ALSModel) -> DataFrame:
    """Both factor tables: ``DF[side, id, n_factors, nonnegative]``."""
    sides = {"user": model.userFactors, "product": model.itemFactors}
    rows = [
        df.select(
            F.lit(side).alias("side"),
            F.col("id").cast("bigint").alias("id"),
            F.size("features").alias("n_factors"),
            F.forall("features", lambda x: x >= 0).alias("nonnegative"),
        )
        for side, df in sides.items()
    ]
    return rows[0].union(rows[1])


def list_facts(rows: DataFrame, interactions: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """One row per user of recommendations with ``rank`` and ``score``.

    Rows, last rank and distinct products; then what should not be: products nobody
    bought, scores above the one before, and, given ``products``, wrong names.
    """
    known = interactions.select("product_id").distinct().withColumn("_known", F.lit(True))
    marked = rows.withColumn("_rising", _rising("score")).join(known, "product_id", "left")
    counts = [
        F.count("*").alias("n"),
        F.max("rank").alias("last_rank"),
        F.count_distinct("product_id").alias("n_products"),
        F.count_if(F.col("_known").isNull()).alias("n_unknown"),
        F.count_if("_rising").alias("n_rising"),
    ]
    if products is not None:
        names = products.select("product_id", F.col("product_name").alias("_name"))
        marked = marked.join(names, "product_id", "left")
        wanted = F.coalesce("_name", F.concat(F.lit("Product "), F.col("product_id")))
        counts.append(_count_if(F.col("product_name") != wanted, "n_misnamed"))
    return marked.groupBy("user_id").agg(*counts)


def list_gaps(rows: DataFrame, other: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Two results of the same question: ``DF[user_id, n, n_other, n_different]``.

    Ranks at which the scores differ by more than ``tolerance``, and products that only
    one list has although their score is not that of the list's end, where equal scores
    may be cut either way.
    """
    names = ["user_id", "product_id", "rank", "score"]
    a, b = rows.select(names), other.select(names)
    last = Window.partitionBy("user_id")
    marked = [
        df.withColumn("open", F.col("score") <= F.min("score").over(last) + tolerance)
        for df in (a, b)
    ]
    ranks = a.select("user_id", "rank", F.col("score").alias("mine")).join(
        b.select("user_id", "rank", F.col("score").alias("theirs")), ["user_id", "rank"], "full"
    )
    off = ~F.coalesce(F.abs(F.col("mine") - F.col("theirs")) <= tolerance, F.lit(False))
    of_ranks = ranks.groupBy("user_id").agg(
        F.count("mine").alias("n"), F.count("theirs").alias("n_other"), F.count_if(off).alias("off")
    )
    alone = [
        x.where("NOT open").join(y, ["user_id", "product_id"], "left_anti").select("user_id")
        for x, y in (marked, marked[::-1])
    ]
    lone = alone[0].union(alone[1]).groupBy("user_id").agg(F.count("*").alias("lone"))
    return of_ranks.join(lone, "user_id", "left").select(
        "user_id", "n", "n_other",
        (F.col("off") + F.coalesce("lone", F.lit(0))).alias("n_different"),
    )


def cells_gap(metrics: DataFrame, predicted: DataFrame, name: str) -> DataFrame:
    """``DF[name, n_rows, gap]``: the cells of a row of metrics against a recount.

    ``predicted`` is ``DF[label, positive]``, from other scores than the metrics.
    """
    counts = predicted.groupBy("label", "positive").agg(F.count("*").alias("n"))
    own = counts.agg(
        *(
            F.coalesce(F.sum(F.when((F.col("label") == label) & test, F.col("n"))), F.lit(0)).alias(c)
            for c, label, test in (
                ("tp", 1, F.col("positive")), ("fp", 0, F.col("positive")),
                ("fn", 1, ~F.col("positive")), ("tn", 0, ~F.col("positive")),
            )
        )
    )
    cells = ["tp", "fp", "fn", "tn"]
    both = metrics.select(*cells).withColumn("own", own.select(F.struct(*cells)).scalar())
    gap = sum((F.abs(F.col(c) - F.col(f"own.{c}")) for c in cells), F.lit(0))
    rows = sum((F.col(c) for c in cells), F.lit(0))
    return both.select(
        F.lit(name).alias("name"), rows.cast("bigint").alias("n_rows"), gap.cast("bigint").alias("gap")
    )


def novel_facts(rows: DataFrame, interactions: DataFrame) -> DataFrame:
    """:func:`list_facts` and the rows a user has bought before, ``n_bought``."""
    bought = rows.join(interactions.select("user_id", "product_id"), ["user_id", "product_id"], "left_semi")
    again = bought.groupBy("user_id").agg(F.count("*").alias("n_bought"))
    return list_facts(rows, interactions).join(again, "user_id", "left").fillna(0, ["n_bought"])


def reorder_facts(
    found: DataFrame, scored: DataFrame, products: DataFrame, threshold: float, k: int = 10
) -> DataFrame:
    """One row per user of ``scored``: pairs judged, and what is wrong with the list ``found``.

    Rows the list is short of, rows under the threshold, scores above the one before,
    and rows that differ from the scored features or the name.
    """
    named = with_product_names(scored, products)
    likely = F.count_if(F.col("probability") >= threshold)
    wanted = named.groupBy("user_id").agg(F.least(likely, F.lit(k).cast("bigint")).alias("_wanted"))
    explained = ["product_name", "product_purchases", "orders_since_last_purchase"]
    digits = {"probability": 4, "purchase_rate": 4, "avg_cart_position": 2}
    truth = named.select(
        "user_id", "product_id",
        F.struct(*explained, *[F.round(c, n).alias(c) for c, n in digits.items()]).alias("_truth"),
    )
    same = F.struct(*explained, *digits).eqNullSafe(F.col("_truth"))
    rows = found.withColumn("_rising", _rising("probability")).join(
        truth, ["user_id", "product_id"], "left"
    )
    lists = rows.groupBy("user_id").agg(
        F.count("*").alias("_n"),
        F.count_if(F.col("probability") < threshold).alias("n_unlikely"),
        F.count_if("_rising").alias("n_rising"),
        F.count_if(~same).alias("n_different"),
    )
    wrong = ["n_unlikely", "n_rising", "n_different"]
    return (
        scored.groupBy("user_id").agg(F.count("*").alias("n_pairs"))
        .join(wanted, "user_id", "left").join(lists, "user_id", "left")
        .fillna(0, ["_wanted", "_n", *wrong])
        .select("user_id", "n_pairs", (F.col("_wanted") - F.col("_n")).alias("n_short"), *wrong)
    )
