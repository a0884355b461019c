"""Hand-made rows for rules the test tables do not exercise."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from basketloom.functions.ranking import hits_at_k, ndcg_at_k, precision_at_k, recall_at_k
from basketloom.operators import classeval, history, popularity, profile, rankeval, reorder, stats
from basketloom.operators import recommend as lists
from basketloom.operators.names import with_product_names
from basketloom.sources.schemas import AISLES, DEPARTMENTS, LINES, ORDERS, PRODUCTS
from basketloom.sources.tables import Tables


@pytest.fixture(scope="module")
def tables(spark):
    """Three users: 1 buys repeatedly, 2 has ties and unknown things, 3 has no lines."""
    orders = [
        (10, 1, "prior", 1, 0, 9),
        (11, 1, "prior", 2, 0, 9),
        (12, 1, "prior", 3, 2, 22),
        (13, 1, "train", 4, 1, 8),
        (20, 2, "prior", 1, 5, 7),
        (21, 2, "prior", 2, 4, 6),
        (22, 2, "test", 3, 4, 6),
        (30, 3, "prior", 1, 6, 23),
    ]
    prior = [
        (10, 100, 1, 0),
        (10, 101, 2, 0),
        (11, 100, 1, 1),
        (12, 100, 2, 1),
        (12, 102, 1, 0),
        (20, 103, 1, 0),
        (21, 999, 1, 0),
    ]
    train = [(13, 100, 1, 1), (13, 100, 1, 1), (13, 104, 2, 0)]
    products = [
        (100, "milk", 1, 1),
        (101, "bread", 2, 2),
        (102, "eggs", 2, 1),
        (103, "stone", 9, 9),
        (104, "rice", 3, 2),
    ]
    return Tables(
        spark.createDataFrame(orders, ORDERS),
        spark.createDataFrame(prior, LINES),
        spark.createDataFrame(train, LINES),
        spark.createDataFrame(products, PRODUCTS),
        spark.createDataFrame([(1, "dairy"), (2, "dry"), (3, "grain")], AISLES),
        spark.createDataFrame([(1, "fresh"), (2, "pantry")], DEPARTMENTS),
    )


def one(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize(
    ("predicted", "actual", "want"),
    [
        ([1, 2, 3, 4], [3, 1, 9], (2, 0.2, 2 / 3, 0.7039180890341347)),
        ([], [8], (0, 0.0, 0.0, 0.0)),
        ([7], [8], (0, 0.0, 0.0, 0.0)),
        ([1], [], (0, 0.0, 0.0, 0.0)),
        (list(range(10)), list(range(20)), (10, 1.0, 0.5, 1.0)),
        ([5, 6], [5, 6], (2, 0.2, 1.0, 1.0)),
        (list(range(12)), [10, 11], (0, 0.0, 0.0, 0.0)),
    ],
)
def test_ranking_of_one_list(spark, predicted, actual, want):
    df = spark.createDataFrame([(predicted, actual)], "p array<bigint>, a array<bigint>")
    p, a = F.col("p"), F.col("a")
    got = one(df, hits_at_k(p, a), precision_at_k(p, a), recall_at_k(p, a), ndcg_at_k(p, a))
    assert tuple(got) == pytest.approx(want)


def test_user_metrics_agree_with_list_metrics(spark):
    rows = [(u, [(u * 7 + i * 3) % 23 for i in range(u % 11)], [(u * 5 + i) % 23 for i in range(1 + u % 14)])
            for u in range(60)]
    both = spark.createDataFrame(rows, "user_id bigint, predicted array<bigint>, actual array<bigint>")
    truth = both.select("user_id", F.explode("actual").alias("product_id"))
    got = rankeval.user_metrics(both.select("user_id", "predicted"), truth.unionAll(truth))
    p, a = F.col("predicted"), F.col("actual")
    want = {
        r.user_id: tuple(r)[1:]
        for r in both.select(
            "user_id", hits_at_k(p, a), precision_at_k(p, a), recall_at_k(p, a), ndcg_at_k(p, a)
        ).collect()
    }
    rows = got.select("user_id", "hits", "precision", "recall", "ndcg").collect()
    assert len(rows) == 60
    for r in rows:
        assert tuple(r)[1:] == pytest.approx(want[r.user_id])
        assert 0 <= r.ndcg <= 1 + 1e-12


def test_users_without_a_list(spark):
    predicted = spark.createDataFrame([(1, [5]), (3, [5])], "user_id bigint, predicted array<bigint>")
    truth = spark.createDataFrame([(1, 5), (2, 5)], "user_id bigint, product_id bigint")
    common = one(rankeval.ranking_metrics(predicted, truth))
    assert (common.n_users, common.recall) == (1, 1.0)
    every = one(rankeval.ranking_metrics(predicted, truth, users="truth"))
    assert (every.n_users, every.recall, every.ndcg) == (2, 0.5, 0.5)
    with pytest.raises(ValueError):
        rankeval.user_metrics(predicted, truth, users="all")


def test_null_user_counts_once(spark):
    orders = spark.createDataFrame([(1,), (None,), (1,)], "user_id bigint")
    assert one(stats.unique_users(orders)).users == 2


def test_statistics(tables):
    got = one(stats.dashboard_stats(tables)).asDict()
    assert got == {
        "orders": 8, "users": 3, "products": 5, "interactions": 7,
        "reorder_rate": 28.57, "basket": 1.4,
    }


def test_statistics_of_no_lines(tables):
    empty = Tables(tables.orders, tables.prior.limit(0), tables.train, tables.products,
                   tables.aisles, tables.departments)
    got = one(stats.dashboard_stats(empty))
    assert (got.interactions, got.reorder_rate, got.basket) == (0, None, None)


def test_histograms_have_all_slots(tables):
    hours = {r.order_hour_of_day: r.n_orders for r in stats.orders_by_hour(tables.orders).collect()}
    assert sorted(hours) == list(range(24))
    assert (hours[3], hours[9], sum(hours.values())) == (0, 2, 8)
    days = {r.order_dow: r.n_orders for r in stats.orders_by_dow(tables.orders).collect()}
    assert days == {0: 2, 1: 1, 2: 1, 3: 0, 4: 2, 5: 1, 6: 1}


def test_unknown_products(tables):
    top = stats.top_products(stats.product_counts(tables.prior), tables.products).collect()
    assert [(r.product_id, r.n) for r in top] == [(100, 3), (101, 1), (102, 1), (103, 1)]
    named = with_product_names(stats.product_counts(tables.prior), tables.products, "left")
    assert {r.product_id: r.product_name for r in named.collect()}[999] == "Product 999"


def test_cohorts(spark, tables):
    assert history.orders_in(tables.orders, "prior", max_user_id=1).count() == 3
    repeated = spark.createDataFrame([(2,), (2,)], "user_id bigint")
    assert history.orders_in(tables.orders, "prior", users=repeated).count() == 2
    assert [r.user_id for r in history.cohort_users(tables.orders).collect()] == [1]
    bought = history.interactions(tables.orders, tables.prior, max_user_id=1)
    assert {tuple(r) for r in bought.collect()} == {(1, 100, 3), (1, 101, 1), (1, 102, 1)}


def test_next_order(tables):
    assert {tuple(r) for r in history.next_order(tables).collect()} == {
        (1, 13, 100, "milk", 1), (1, 13, 104, "rice", 0)
    }
    assert history.actual_sets(tables.orders, tables.train).count() == 2


def test_leave_last_order_out(tables):
    prior = history.orders_in(tables.orders, "prior")
    split = history.leave_last_order_out(prior)
    assert {r.order_id for r in split.where("split = 'validation'").collect()} == {12, 21, 30}
    assert {r.order_id for r in split.where("split = 'history'").collect()} == {10, 11, 20}


def test_profile(tables):
    rows = {r.user_id: r for r in profile.customer_profile(tables).collect()}
    assert sorted(rows) == [1, 2, 3]
    first = rows[1]
    assert (first.orders, first.purchases, first.unique_products) == (3, 5, 3)
    assert first.reorder_rate == 40.0
    # milk 3 of 5 lines in aisle 1; milk and eggs 4 of 5 in department 1
    assert (first.favorite_aisle, first.favorite_aisle_share) == ("dairy", 60.0)
    assert (first.favorite_department, first.favorite_department_share) == ("fresh", 80.0)
    assert (first.favorite_order_day, first.favorite_order_day_share) == (0, 66.7)
    assert (first.favorite_order_hour, first.favorite_order_hour_share) == (9, 66.7)


def test_profile_ties_and_unknowns(tables):
    rows = {r.user_id: r for r in profile.customer_profile(tables).collect()}
    second, third = rows[2], rows[3]
    assert (second.favorite_order_day, second.favorite_order_hour) == (4, 6)
    assert (second.purchases, second.unique_products) == (2, 2)
    assert (second.favorite_aisle, second.favorite_aisle_share) == ("Unknown", None)
    assert (second.favorite_department, second.favorite_department_share) == ("Unknown", None)
    assert (third.orders, third.purchases, third.unique_products) == (1, 0, 0)
    assert (third.reorder_rate, third.favorite_aisle) == (None, "Unknown")


def test_profile_of_chosen_users(spark, tables):
    some = spark.createDataFrame([(3,), (77,)], "user_id bigint")
    assert [r.user_id for r in profile.customer_profile(tables, some).collect()] == [3]


def test_popular_and_novel(tables):
    users = tables.orders.select("user_id").distinct()
    popular = popularity.popularity_recommendations(stats.product_counts(tables.prior), users, 3)
    assert {tuple(r.predicted) for r in popular.collect()} == {(100, 101, 102)}
    bought = history.interactions(tables.orders, tables.prior)
    fresh = lists.novel_recommendations(lists.list_rows(popular), bought, 2)
    assert {tuple(r) for r in fresh.select("user_id", "rank", "product_id").collect()} == {
        (2, 1, 100), (2, 2, 101), (3, 1, 100), (3, 2, 101)
    }


def test_features_and_labels(tables):
    features = {
        (r.user_id, r.product_id): r
        for r in reorder.reorder_features(tables.orders, tables.prior).collect()
    }
    milk = features[1, 100]
    assert (milk.product_purchases, milk.first_order, milk.last_order) == (3, 1, 3)
    assert milk.avg_cart_position == pytest.approx(4 / 3)
    assert (milk.user_orders, milk.purchase_rate, milk.orders_since_last_purchase) == (3, 1.0, 0)
    assert features[1, 101].orders_since_last_purchase == 2
    labelled = reorder.reorder_dataset(tables.orders, tables.prior, tables.train)
    assert {(r.product_id, r.label) for r in labelled.collect()} == {
        (100, 1.0), (101, 0.0), (102, 0.0)
    }
    every = reorder.reorder_dataset(
        tables.orders, tables.prior, tables.train, labelled_only=False
    )
    assert every.count() == 5


def test_training_and_serving_features_agree(spark, tables):
    one_user = spark.createDataFrame([(1,)], "user_id bigint")
    served = reorder.reorder_features(tables.orders, tables.prior, users=one_user)
    trained = reorder.reorder_dataset(tables.orders, tables.prior, tables.train).drop("label")
    assert served.exceptAll(trained).isEmpty() and trained.exceptAll(served).isEmpty()


@pytest.fixture(scope="module")
def scored(spark):
    rows = [((i * 37 % 101) / 100, float(i * 13 % 7 == 0)) for i in range(400)]
    return spark.createDataFrame(rows + [(None, 1.0), (0.5, None)], "probability double, label double")


def test_sweep_equals_single_thresholds(scored):
    sweep = classeval.threshold_sweep(scored, classeval.WIDE_THRESHOLDS).collect()
    assert [r.threshold for r in sweep] == pytest.approx([i / 20 for i in range(2, 19)])
    for r in sweep:
        alone = one(classeval.classification_metrics(scored, r.threshold))
        assert (r.tp, r.fp, r.fn, r.tn) == (alone.tp, alone.fp, alone.fn, alone.tn)
        assert r.tp + r.fp + r.fn + r.tn == 400
        assert r.f1 == pytest.approx(alone.f1)
    assert all(a.recall >= b.recall for a, b in zip(sweep, sweep[1:]))


def test_best_threshold(spark):
    def best(*rows):
        return one(classeval.best_threshold(spark.createDataFrame(rows, "threshold double, f1 double")))

    assert best((0.3, 0.5), (0.2, 0.5), (0.4, 0.1)).threshold == 0.2
    assert best((0.2, 0.0), (0.3, 0.0)).threshold == 0.0


def test_rates_without_positives(spark):
    rows = spark.createDataFrame([(0.0, 0.05, 0.0)], "label double, probability double, prediction double")
    for got in (one(classeval.classification_metrics(rows, 0.2)), one(classeval.classification_metrics(rows))):
        assert (got.precision, got.recall, got.f1, got.accuracy) == (0.0, 0.0, 0.0, 1.0)


def test_threshold_is_inclusive(spark):
    rows = spark.createDataFrame([(1.0, 0.2)], "label double, probability double")
    assert one(classeval.confusion(rows, 0.2)).tp == 1
    assert {r.threshold: r.tp for r in classeval.threshold_sweep(rows).collect()}[0.2] == 1


def test_ideal_gain_matches_definition(spark):
    df = spark.createDataFrame([(list(range(10)), [0, 9])], "p array<bigint>, a array<bigint>")
    got = one(df, ndcg_at_k(F.col("p"), F.col("a")))[0]
    assert got == pytest.approx((1 + 1 / math.log2(11)) / (1 + 1 / math.log2(3)))


def test_lists_are_spread_before_they_become_rows(spark):
    """All users in one task; their lists are judged in as many as a shuffle has."""
    users = spark.range(200).select(F.col("id").alias("user_id")).distinct()
    predicted = users.withColumn("predicted", F.array(*(F.lit(i).cast("bigint") for i in range(10))))
    truth = users.select("user_id", (F.col("user_id") % 20).alias("product_id"))
    metrics = rankeval.user_metrics(predicted, truth)
    assert metrics.agg(F.sum("hits")).first()[0] == 100
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("REPARTITION_BY_NUM")


def test_tasks_of_lists_follow_their_number(spark, monkeypatch):
    """Few lists are not dealt to as many tasks as a shuffle may have."""
    predicted = spark.range(200).select(
        F.col("id").alias("user_id"), F.array(F.lit(1).cast("bigint")).alias("predicted")
    )
    truth = predicted.select("user_id", F.lit(1).cast("bigint").alias("product_id"))
    cores = spark.sparkContext.defaultParallelism
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "150")
        for most, tasks in ((20_000, cores), (2, 100)):
            monkeypatch.setattr(rankeval, "LISTS", most)
            metrics = rankeval.user_metrics(predicted, truth)
            plan = metrics._jdf.queryExecution().executedPlan().toString()
            line = next(x for x in plan.splitlines() if "REPARTITION_BY_NUM" in x)
            assert f", {tasks})" in line
            assert metrics.agg(F.sum("hits")).first()[0] == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_forest_partitions_follow_the_rows(spark, monkeypatch):
    """More rows are dealt to more partitions, few to the fixed number."""
    asked = []
    frame = type(spark.range(0))
    dealt = frame.repartition
    monkeypatch.setattr(
        frame, "repartition", lambda df, n, *by: asked.append(n) or dealt(df, n, *by)
    )
    i = F.col("id")
    rows = spark.range(400).select(
        (i % 20).alias("user_id"), i.alias("product_id"), (i % 2).cast("double").alias("label"),
        *((i * n % 7).cast("double").alias(c) for n, c in enumerate(reorder.FEATURES, 1)),
    )
    reorder.fit_reorder(rows, trees=1, depth=1)
    monkeypatch.setattr(reorder, "PARTITION_ROWS", 20)
    reorder.fit_reorder(rows, trees=1, depth=1)
    assert asked == [reorder.PARTITIONS, 20]
