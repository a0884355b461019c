"""The line table from made-up sales: same rows whichever orders and users count as large."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from basketloom.functions import numbering
from basketloom.sources import adapters


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sales"))
    day = datetime.datetime(2020, 1, 1)
    orders = [(o, o % 3, day + datetime.timedelta(days=o)) for o in range(40)] + [(40, None, day)]
    # Order 7 is long, repeats products, and has a line without a product.
    lines = [(o, (o * k) % 5 + 1, k + 1) for o in range(41) for k in range(3)]
    lines += [(7, p % 60 + 1, p % 9) for p in range(200)] + [(7, None, 2), (None, 1, 1), (99, 1, 1)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(
        f"{path}/orders.parquet"
    )
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int").write.parquet(
        f"{path}/lineitem.parquet"
    )
    parts = [(p, f"p{p}", f"b{p % 3}", f"t{p % 2}") for p in range(1, 61)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(
        f"{path}/part.parquet"
    )
    return path, orders, lines


def expected(orders, lines):
    rank, last, first = {}, {}, {}
    for o, user, _ in sorted((x for x in orders if x[1] is not None), key=lambda x: (x[1], x[2], x[0])):
        last[user] = last.get(user, 0) + 1
        rank[o] = (user, last[user])
    baskets = {}
    for o, p, at in lines:
        if o in rank:
            baskets.setdefault(o, {}).setdefault(p, []).append(at)
    for o, products in baskets.items():
        user, number = rank[o]
        for p in products:
            first[user, p] = min(first.get((user, p), number), number)
    rows = set()
    for o, products in baskets.items():
        user, number = rank[o]
        # A line without a product takes a place in the basket, but is left out.
        places = sorted(products, key=lambda p: (min(products[p]), p is not None, p or 0))
        for n, p in enumerate(places, 1):
            if p is not None:
                rows.add((o, p, n, int(number > first[user, p]), number < last[user]))
    return rows


@pytest.mark.parametrize("most, bits", [(100_000, 17), (4, 1)])
def test_lines(spark, source, tmp_path, monkeypatch, most, bits):
    path, orders, lines = source
    monkeypatch.setattr(numbering, "GROUP_ROWS", most)
    monkeypatch.setattr(adapters, "SPAN_BITS", bits)
    t = adapters.store_sales(spark, path, str(tmp_path))
    got = t.prior.withColumn("prior", F.lit(True)).union(t.train.withColumn("prior", F.lit(False)))
    names = ["order_id", "product_id", "add_to_cart_order", "reordered", "prior"]
    rows = [tuple(r) for r in got.select(names).collect()]
    want = expected(orders, lines)
    held = {r[0] for r in want if not r[4]} - {r[0] for r in rows if not r[4]}
    # Orders held back for the test users are in neither part.
    want = {r for r in want if r[0] not in held}
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert held <= {o for o, user, _ in orders if user is not None and user % 5 == 0}


def test_lines_are_shuffled_by_order_once(spark, source):
    path = source[0]
    lines = adapters._read(spark, path, "lineitem").toDF("order_id", "product_id", "_position")
    header = spark.range(40).select(
        F.col("id").alias("order_id"), F.col("id").alias("user_id"),
        F.lit(1).alias("order_number"), F.lit("prior").alias("eval_set"),
    )
    placed = adapters._placed(lines, header, ["_position", "product_id"], [F.col("_position")])
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") <= 2
