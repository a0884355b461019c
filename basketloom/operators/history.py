"""Orders and their lines: cohorts, purchase counts and the next order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.functions.numbering import number_sorted
from basketloom.operators.names import with_product_names
from basketloom.sources.tables import Tables


def restrict(df: DataFrame, users: DataFrame | None) -> DataFrame:
    """Rows of the given users; all rows when ``users`` is None.

    A semi join, so ``users`` may repeat. Give them straight from a table where
    possible: AQE splits a user with very many rows only between plain shuffles,
    not against the outcome of an aggregate such as ``distinct``.
    """
    return df if users is None else df.join(users.select("user_id"), "user_id", "left_semi")


def orders_in(
    orders: DataFrame,
    eval_set: str,
    max_user_id: int | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Orders of one evaluation set, optionally only for users up to an id or in a list."""
    chosen = orders.where(F.col("eval_set") == eval_set)
    if max_user_id is not None:
        chosen = chosen.where(F.col("user_id") <= max_user_id)
    return restrict(chosen, users)


def cohort_users(orders: DataFrame, max_user_id: int | None = None) -> DataFrame:
    """Users with a next order to compare with: ``DF[user_id]``."""
    return orders_in(orders, "train", max_user_id).select("user_id").distinct()


def history(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with the ``user_id`` and ``order_number`` of their order."""
    return lines.join(orders.select("order_id", "user_id", "order_number"), "order_id")


def user_products(lines: DataFrame) -> DataFrame:
    """Everything the operators need to know of a (user, product) pair, from :func:`history`.

    ``DF[user_id, product_id, purchases, reorders, marked, first_order, last_order,
    avg_cart_position]``. One aggregate, combined before the shuffle, from which
    Spark drops the columns a caller does not select. Several operators on the
    same lines can share it: made durable, it replaces the lines and their join.
    """
    return lines.groupBy("user_id", "product_id").agg(
        F.count("*").alias("purchases"),
        F.sum("reordered").alias("reorders"),
        F.count("reordered").alias("marked"),
        F.min("order_number").alias("first_order"),
        F.max("order_number").alias("last_order"),
        F.avg("add_to_cart_order").alias("avg_cart_position"),
    )


def interactions(
    orders: DataFrame,
    prior: DataFrame,
    max_user_id: int | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """How often each user bought each product: ``DF[user_id, product_id, purchases]``."""
    lines = history(prior, orders_in(orders, "prior", max_user_id, users))
    return user_products(lines).select("user_id", "product_id", "purchases")


def purchase_history(tables: Tables, users: DataFrame | None = None) -> DataFrame:
    """Named purchase counts per user: ``DF[user_id, product_id, product_name, purchases]``.

    Unsorted, since sorting all users' products costs another shuffle;
    :func:`ranked_history` does so.
    """
    bought = interactions(tables.orders, tables.prior, users=users)
    return with_product_names(bought, tables.products).select(
        "user_id", "product_id", "product_name", "purchases"
    )


def ranked_history(tables: Tables, users: DataFrame | None = None) -> DataFrame:
    """:func:`purchase_history` in each user's order of purchases.

    ``DF[user_id, product_id, product_name, purchases, rank]``: ranks from 1, most bought
    first, ties by product id, over all products of a user, however many there are.
    """
    named = purchase_history(tables, users)
    return number_sorted(named, ["user_id"], [F.desc("purchases"), "product_id"], "rank")


def next_order_lines(
    orders: DataFrame,
    train: DataFrame,
    max_user_id: int | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Lines of each user's next order: ``DF[user_id, order_id, product_id, reordered]``."""
    return history(train, orders_in(orders, "train", max_user_id, users)).select(
        "user_id", "order_id", "product_id", "reordered"
    )


def next_order(tables: Tables, users: DataFrame | None = None) -> DataFrame:
    """Named products of the next order of each user."""
    lines = next_order_lines(tables.orders, tables.train, users=users)
    return with_product_names(lines, tables.products).select(
        "user_id", "order_id", "product_id", "product_name", "reordered"
    )


def actual_sets(
    orders: DataFrame,
    train: DataFrame,
    max_user_id: int | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """Distinct products of each user's next order: ``DF[user_id, product_id]``.

    One row per element instead of one array per user, so that no basket has to
    fit into one row.
    """
    lines = next_order_lines(orders, train, max_user_id, users)
    return lines.select("user_id", "product_id").distinct()


def last_orders(orders: DataFrame) -> DataFrame:
    """Highest order number per user: ``DF[user_id, user_orders]``."""
    return orders.groupBy("user_id").agg(F.max("order_number").alias("user_orders"))


def leave_last_order_out(orders: DataFrame) -> DataFrame:
    """Add ``split``: ``validation`` for the last order of each user, else ``history``.

    The maximum is joined back on user and order number. Both keys spread the
    orders of a busy user over all tasks, where a window would sort them in one.
    """
    last = last_orders(orders).select(
        "user_id", F.col("user_orders").alias("order_number"), F.lit("validation").alias("split")
    )
    return orders.join(last, ["user_id", "order_number"], "left").fillna(
        "history", subset=["split"]
    )
