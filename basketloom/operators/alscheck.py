"""Is a factorisation a solution? The optimality conditions of its last step.

The users' factors are solved last, each alone: with the products' factors fixed, a
user's factors are the nonnegative minimum of a quadratic function. At a minimum the
gradient is zero where a factor is positive and not negative where it is zero, which
holds for any fit and for no others.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.operators.als import ALPHA, REG

#: Largest gradient, in parts of the largest entry of the right side. The solver stops
#: at small steps and factors are stored in single precision.
TOLERANCE = 1e-5


def _dot(left: str, right: str, rank: int) -> Column:
    return reduce(add, (F.col(left)[i] * F.col(right)[i] for i in range(rank)))


def _factors(factors: DataFrame, id_name: str, name: str) -> DataFrame:
    return factors.select(
        F.col("id").cast("bigint").alias(id_name),
        F.col("features").cast("array<double>").alias(name),
    )


def gram_matrix(factors: DataFrame, rank: int) -> DataFrame:
    """One row ``DF[gram: array<array<double>>]``: sums of products of all pairs of factors.

    A partial aggregate per task, ``rank`` rows of ``rank`` sums.
    """
    x = F.col("features").cast("array<double>")
    entries = factors.select(F.posexplode(x).alias("i", "x"), x.alias("y"))
    sums = F.array(*(F.sum(F.col("x") * F.col("y")[j]) for j in range(rank)))
    rows = entries.groupBy("i").agg(sums.alias("row"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "row")))
    return rows.agg(F.transform(ordered, lambda r: r["row"]).alias("gram"))


def user_optimality(
    users: DataFrame,
    products: DataFrame,
    interactions: DataFrame,
    rank: int,
    reg: float = REG,
    alpha: float = ALPHA,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``DF[user_id, n_products, gap, optimal]``: one row per user of the factors or purchases.

    ``users`` and ``products`` are factor tables ``DF[id, features]``, as a model has
    them, ``interactions`` the rows it was fitted on. ``gap`` is the largest violation
    of the conditions, relative to the right side of the user's equations; it is null
    for a user without factors, without purchases or with a product that has no factors,
    who is not optimal.

    The squared factors of all products are summed once; a user adds only the products
    bought. Purchases meet the products' factors and then the user's, and become a sum
    per user in the same place.
    """
    bought = interactions.select("user_id", "product_id", F.col("purchases").cast("double"))
    rows = bought.join(_factors(products, "product_id", "y"), "product_id", "left").join(
        _factors(users, "user_id", "x"), "user_id", "left"
    )
    extra = F.abs("purchases") * F.lit(alpha)
    wanted = F.when(F.col("purchases") > 0, extra + 1).otherwise(0.0)
    weighted = rows.select(
        "user_id", "purchases", "y", wanted.alias("wanted"),
        (extra * _dot("x", "y", rank) - wanted).alias("weight"),
    )

    def total(weight: str) -> Column:
        return F.array(*(F.sum(F.col(weight) * F.col("y")[j]) for j in range(rank)))

    sums = weighted.groupBy("user_id").agg(
        F.count("*").alias("n_products"),
        F.count_if(F.col("purchases") > 0).alias("positive"),
        F.count_if(F.col("y").isNull()).alias("unknown"),
        total("weight").alias("of_bought"),
        total("wanted").alias("right_side"),
    )
    both = _factors(users, "user_id", "x").join(sums, "user_id", "full").withColumn(
        "gram", gram_matrix(products, rank).scalar()
    )
    spread = F.transform(
        "gram",
        lambda row: F.aggregate(
            F.zip_with(row, F.col("x"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v
        ),
    )
    pull = F.col("positive") * F.lit(reg)
    gradient = F.zip_with(
        F.zip_with(spread, "of_bought", lambda a, b: a + b), "x", lambda g, x: g + pull * x
    )
    # Where a factor is zero only a falling slope is wrong.
    wrong = F.zip_with(
        "gradient", "x",
        lambda g, x: F.when(x > 0, F.abs(g)).when(x == 0, F.greatest(-g, F.lit(0.0)))
        .otherwise(F.lit(float("inf"))),
    )
    scale = F.array_max(F.transform("right_side", F.abs))
    judged = both.withColumn("gradient", gradient).withColumn(
        "gap",
        F.when(F.col("unknown") == 0, F.array_max(wrong) / F.greatest(scale, F.lit(1e-9))),
    )
    return judged.select(
        "user_id",
        F.coalesce("n_products", F.lit(0).cast("bigint")).alias("n_products"),
        "gap",
        F.coalesce(F.col("gap") <= tolerance, F.lit(False)).alias("optimal"),
    )
