"""Best products by inner product without scoring every product for every user.

No score exceeds the product of the two vectors' lengths. Products are taken from the
longest vector on, in layers that grow; once a user's k-th score is above what the next
layer's longest vector could reach, the user is done, and inside a layer a user meets
only the blocks of products that still could matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketloom.functions.numbering import number_sorted
from basketloom.sources.durable import durable

#: Products of the first layer, how many times as many are seen after each further
#: one, and the products of a block.
FIRST = 128
GROWTH = 4
BLOCK = 1024

#: Users that meet a block of products in one place.
GROUP = 2048

#: The bound is computed in floating point.
_SLACK = 1 + 1e-9


@dataclass(frozen=True)
class Search:
    """Rows ``DF[user_id, product_id, rank, score]`` and how many of all pairs were scored."""

    rows: DataFrame
    scored: int
    pairs: int

    @property
    def share(self) -> float:
        return self.scored / self.pairs if self.pairs else 0.0


def _vectors(factors: DataFrame, id_name: str, prefix: str, rank: int) -> DataFrame:
    """Factors as columns, which keeps the products of them in generated code."""
    columns = [F.col("features")[i].cast("double").alias(f"{prefix}{i}") for i in range(rank)]
    rows = factors.select(F.col("id").cast("bigint").alias(id_name), *columns)
    length = F.sqrt(reduce(add, (F.col(f"{prefix}{i}") * F.col(f"{prefix}{i}") for i in range(rank))))
    return rows.withColumn(f"{prefix}_length", length)


def _first_k(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy(F.desc("score"), F.asc("product_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_best(
    users: DataFrame,
    products: DataFrame,
    rank: int,
    k: int = 10,
    without: DataFrame | None = None,
    first: int = FIRST,
    block: int = BLOCK,
    group: int = GROUP,
) -> Search:
    """The ``k`` highest scores of each user, ties to the smaller product id; exact.

    ``users`` and ``products`` are factor tables ``DF[id, features]``. Pairs in
    ``without`` (``DF[user_id, product_id]``) are left out, so that a list is filled
    with others. ``scored`` of the result counts the products met, of all ``pairs``.

    The ``first`` longest products are sent to all users where they are. From then on
    users are dealt into groups and products into blocks, and the two meet by an equal
    key of both; scores below a user's k-th so far go no further. There are as many
    rounds as powers of ``GROWTH`` between ``first`` and the number of products, each
    written to the shared folder. Besides the first layer one number per block, its longest
    vector, is what all tasks get; a few sums per round come back to the driver.
    """
    u = _vectors(users, "user_id", "u", rank)
    p = _vectors(products, "product_id", "p", rank)
    n_users, n_products = u.count(), p.count()
    if n_products > first:
        placed = number_sorted(p, [], [F.desc("p_length"), "product_id"], "place")
        p = durable(
            placed.withColumn("block", F.floor((F.col("place") - 1) / block)), "products-by-length"
        )
    groups = max(1, -(-n_users // group))
    spread = F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int")
    score = reduce(add, (F.col(f"u{i}") * F.col(f"p{i}") for i in range(rank)))
    left_out = None if without is None else without.select("user_id", "product_id")

    def scores(met: DataFrame, *columns: str) -> DataFrame:
        return met.select("user_id", "product_id", score.alias("score"), *columns)

    def allowed(rows: DataFrame) -> DataFrame:
        if left_out is None:
            return rows
        return rows.join(left_out, ["user_id", "product_id"], "left_anti")

    # Every user meets the first layer whole, and it is at most ``first`` rows.
    start, end = 0, min(first, n_products)
    longest = p.where(F.col("place") <= end) if n_products > first else p
    met = scores(u.crossJoin(F.broadcast(longest)))
    best = durable(_first_k(allowed(met), k), "best")
    scored = n_users * end
    start, end = end, min(end * GROWTH, n_products)
    u = u.withColumn("group", spread)
    while start < end:
        layer = p.where(F.col("place").between(start + 1, end))
        blocks = layer.groupBy("block").agg(
            F.max("p_length").alias("longest"), F.count("*").alias("n")
        )
        bounds = blocks.agg(F.sort_array(F.collect_list(F.struct("block", "longest", "n"))))
        # Blocks are in order of their longest vectors: those a user needs come first.
        floor = best.groupBy("user_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        active = u.join(floor.where(F.col("n") >= k).drop("n"), "user_id", "left")
        needed = F.filter(
            "bounds",
            lambda b: F.col("least").isNull()
            | (F.col("u_length") * b["longest"] * _SLACK >= F.col("least")),
        )
        cells = active.withColumn("bounds", bounds.scalar()).withColumn("cell", F.explode(needed))
        cells = cells.withColumn("block", F.col("cell.block"))
        met = cells.drop("bounds", "cell").join(_copies(layer, groups), ["block", "group"])
        likely = allowed(
            scores(met, "least").where(
                F.col("least").isNull() | (F.col("score") >= F.col("least"))
            ).drop("least")
        )
        met_now = cells.agg(F.sum("cell.n")).first()[0]
        if not met_now:
            break
        best = durable(_first_k(best.drop("rank").unionByName(likely), k), "best")
        scored += met_now
        start, end = end, min(end * GROWTH, n_products)
    return Search(
        best.select("user_id", "product_id", "rank", "score"), scored, n_users * n_products
    )


def _copies(layer: DataFrame, groups: int) -> DataFrame:
    """The products of a layer for every group of users."""
    each: Column = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    return layer.drop("place").withColumn("group", each)
