"""What is said of fitted results is true of right ones and false of disturbed ones."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketloom.operators import als, alscheck, classeval, forest, rankeval, reorder, topk
from basketloom.operators.recommender import Recommender
from basketloom.plans import facts

FACTORS = "id int, features array<float>"
BOUGHT = "user_id bigint, product_id bigint, purchases bigint"


@pytest.fixture(scope="module")
def bought(spark):
    rng = random.Random(1)
    rows = {(rng.randrange(60), min(rng.randrange(40), rng.randrange(40))) for _ in range(700)}
    df = spark.createDataFrame([(u, p, rng.randrange(1, 9)) for u, p in sorted(rows)], BOUGHT)
    return als.durable(df, "bought")


@pytest.fixture(scope="module")
def model(bought):
    return als.fit_als(bought, rank=6, iterations=3)


def optimal(users, products, bought):
    rows = alscheck.user_optimality(users, products, bought, 6).collect()
    return {r.user_id: r for r in rows}


def test_all_users_of_a_fit_are_optimal(model, bought):
    found = optimal(model.userFactors, model.itemFactors, bought)
    counts = {r.user_id: r.n for r in bought.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert {u: r.n_products for u, r in found.items()} == counts
    assert all(r.optimal and r.gap < alscheck.TOLERANCE for r in found.values())


def test_the_gap_is_that_of_plain_matrices(model, bought):
    users, products = (
        {r.id: np.array(r.features, float) for r in df.collect()}
        for df in (model.userFactors, model.itemFactors)
    )
    gram = sum(np.outer(y, y) for y in products.values())
    rows = bought.collect()
    changed = {u: x + 0.05 * (u % 3) for u, x in users.items()}
    df = model.userFactors.select(
        "id", F.expr("transform(features, x -> CAST(x + 0.05 * (id % 3) AS float))").alias("features")
    )
    found = optimal(df, model.itemFactors, bought)
    for u, x in changed.items():
        x = x.astype(np.float32).astype(float)
        own = [(products[r.product_id], als.ALPHA * r.purchases) for r in rows if r.user_id == u]
        left = gram + sum(c * np.outer(y, y) for y, c in own) + len(own) * als.REG * np.eye(6)
        right = sum((1 + c) * y for y, c in own)
        slope = left @ x - right
        wrong = np.where(x > 0, abs(slope), np.maximum(-slope, 0))
        assert found[u].gap == pytest.approx(wrong.max() / abs(right).max(), rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("change", ["x * 1.05", "x + 0.02", "-x", "CAST(0 AS float)"])
def test_disturbed_users_are_not_optimal(model, bought, change):
    users = model.userFactors.select(
        "id",
        F.expr(f"IF(id % 2 = 0, transform(features, x -> CAST({change} AS float)), features)").alias("features"),
    )
    found = optimal(users, model.itemFactors, bought)
    assert {u for u, r in found.items() if not r.optimal} == {u for u in found if u % 2 == 0}


def test_other_products_make_users_wrong(model, bought):
    products = model.itemFactors.select(
        "id", F.expr("IF(id = 0, transform(features, x -> CAST(x + 0.3 AS float)), features)").alias("features")
    )
    found = optimal(model.userFactors, products, bought)
    assert sum(not r.optimal for r in found.values()) > len(found) / 2


def test_users_without_factors_or_purchases_are_not_optimal(spark, model, bought):
    none = optimal(model.userFactors.where("id <> 3"), model.itemFactors, bought.where("user_id <> 4"))
    assert not none[3].optimal and none[3].gap is None
    assert not none[4].optimal and none[4].n_products == 0
    none = optimal(model.userFactors, model.itemFactors.where("id <> 5"), bought)
    buyers = {r.user_id for r in bought.where("product_id = 5").collect()}
    assert {u for u, r in none.items() if r.gap is None} == buyers != set()
    empty = spark.createDataFrame([], FACTORS)
    assert optimal(empty, empty, bought.limit(0)) == {}


def made_factors(n, rank, rng, kinds=None):
    """Factors of very different lengths, some equal, some zero."""
    rows = []
    for i in range(n):
        size = 0 if i % 17 == 5 else 2.0 ** -rng.randrange(12)
        rows.append([float(np.float32(size * rng.random())) for _ in range(rank)])
    for i in range(0, n, 7):
        rows[i] = rows[0]
    order = list(range(n))
    rng.shuffle(order)
    return [(i, rows[i]) for i in order]


def brute_best(users, products, k, without=()):
    out = set()
    for u, x in users:
        scored = sorted(
            (-sum(a * b for a, b in zip(x, y)), p) for p, y in products if (u, p) not in without
        )
        out |= {(u, p, r + 1) for r, (_, p) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("k,first,block,group", [(3, 4, 3, 5), (10, 16, 4, 100), (200, 256, 1024, 2048)])
def test_search_equals_scoring_all_pairs(spark, k, first, block, group):
    rng = random.Random(k)
    users, products = made_factors(40, 4, rng), made_factors(120, 4, rng)
    u, p = (spark.createDataFrame(rows, FACTORS) for rows in (users, products))
    found = topk.search_best(u, p, 4, k, first=first, block=block, group=group)
    got = {(r.user_id, r.product_id, r["rank"]) for r in found.rows.collect()}
    assert got == brute_best(users, products, k)
    assert found.pairs == 4800 and found.share <= 1
    if k == 3:
        assert found.share < 0.5
    some = [(a, b) for a, _ in users for b, _ in products if (a * b) % 3 == 0]
    without = spark.createDataFrame(some, "user_id bigint, product_id bigint")
    found = topk.search_best(u, p, 4, k, without, first=first, block=block, group=group)
    got = {(r.user_id, r.product_id, r["rank"]) for r in found.rows.collect()}
    assert got == brute_best(users, products, k, set(some))


def test_search_of_nothing(spark):
    none, one = spark.createDataFrame([], FACTORS), spark.createDataFrame([(1, [1.0])], FACTORS)
    assert topk.search_best(none, one, 1).rows.collect() == []
    assert topk.search_best(one, none, 1).rows.collect() == []
    assert [tuple(r) for r in topk.search_best(one, one, 1).rows.collect()] == [(1, 1, 1, 1.0)]


def test_search_has_no_product_of_tables(model):
    plan = als.recommend(model)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_search_agrees_with_the_model(model):
    every = model.userFactors.select(F.col("id").alias("user_id"))
    gaps = facts.list_gaps(als.recommend(model, 5), als.recommend(model, 5, every)).collect()
    assert len(gaps) == 60 and all((r.n, r.n_other, r.n_different) == (5, 5, 0) for r in gaps)
    wrong = als.recommend(model, 5).withColumn("score", F.col("score") + (F.col("user_id") % 2) * 0.1)
    gaps = facts.list_gaps(wrong, als.recommend(model, 5, every)).collect()
    assert all((r.n_different > 0) == (r.user_id % 2 == 1) for r in gaps)


@pytest.fixture(scope="module")
def dataset(spark):
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        orders, last, first = rng.randrange(2, 40), rng.randrange(1, 40), rng.randrange(1, 9)
        label = float(rng.random() < 0.1 + 0.6 * (last > 20) * (orders < 30))
        rows.append((i % 200, i, rng.randrange(1, 9), first, last, rng.random() * 20, orders,
                     rng.random(), rng.randrange(30), label))
    schema = ("user_id bigint, product_id bigint, product_purchases bigint, first_order bigint,"
              " last_order bigint, avg_cart_position double, user_orders bigint, purchase_rate double,"
              " orders_since_last_purchase bigint, label double")
    return als.durable(spark.createDataFrame(rows, schema), "dataset")


@pytest.fixture(scope="module")
def trees(dataset):
    return reorder.fit_reorder(dataset, trees=4, depth=5, sampled=False)


def changed_nodes(table, **columns):
    return forest.Forest(table.nodes.withColumns({c: F.expr(e) for c, e in columns.items()}), table.depth)


def test_nodes_give_the_scores_of_the_model(dataset, trees):
    for model in (trees, reorder.fit_reorder(dataset, trees=7, depth=4)):
        table = forest.forest_table(model)
        both = forest.walk(table, reorder.score_reorder(model, dataset))
        assert both.where("abs(probability - walked) > 1e-12").isEmpty()
        other = changed_nodes(table, threshold="threshold + IF(node = 0, 3, 0)")
        both = forest.walk(other, reorder.score_reorder(model, dataset))
        assert both.where("abs(probability - walked) > 1e-9").count() > 10


def test_a_tree_of_one_node(dataset):
    model = reorder.fit_reorder(dataset.where("label = 0"), trees=2, depth=3)
    table = forest.forest_table(model)
    assert table.depth == 0
    assert forest.walk(table, dataset).select("walked").distinct().count() == 1


def test_fit_is_what_its_rows_say(dataset, trees):
    table = forest.forest_table(trees)
    rows = forest.fit_check(table, dataset).orderBy("tree").collect()
    positive = dataset.where("label = 1").count()
    assert [(r.tree, r.n_rows, r.n_positive) for r in rows] == [(t, 3000, positive) for t in range(4)]
    assert all(r.n_nodes > 5 for r in rows)
    wrong = ["wrong_counts", "wrong_impurities", "wrong_gains"]
    assert all(r[w] == 0 for r in rows for w in wrong)


@pytest.mark.parametrize(
    "column,change,wrong",
    [("counts", "IF(node = 1, array(counts[0] + 1, counts[1]), counts)", "wrong_counts"),
     ("gain", "gain * IF(node = 0, 1.01, 1)", "wrong_gains"),
     ("impurity", "impurity + IF(node = 1, 0.001, 0)", "wrong_impurities"),
     ("threshold", "threshold + IF(node = 0, 2, 0)", "wrong_counts")],
)
def test_a_disturbed_tree_is_found(dataset, trees, column, change, wrong):
    other = changed_nodes(forest.forest_table(trees), **{column: change})
    assert all(r[wrong] > 0 for r in forest.fit_check(other, dataset).collect())


def test_a_fit_on_other_rows_is_found(dataset, trees):
    table = forest.forest_table(trees)
    assert all(r.wrong_counts for r in forest.fit_check(table, dataset.where("product_id <> 7")).collect())
    sampled = forest.forest_table(reorder.fit_reorder(dataset, trees=3, depth=3))
    assert all(r.wrong_counts for r in forest.fit_check(sampled, dataset).collect())


def test_cells_are_recounted(dataset, trees):
    scored = reorder.score_reorder(trees, dataset)
    walked = forest.walk(forest.forest_table(trees), dataset)
    metrics = classeval.classification_metrics(scored, 0.3)
    for threshold, same in ((0.3, True), (0.6, False)):
        row = facts.cells_gap(metrics, walked.select("label", (F.col("walked") >= threshold).alias("positive")), "x").first()
        assert row.n_rows == 3000 and (row.gap == 0) == same


def test_metrics_judged_twice(spark):
    truth = spark.createDataFrame(
        [(1, 10), (1, 11), (2, 10), (3, 12), (3, 12), (5, 9)], "user_id bigint, product_id bigint"
    ).distinct()
    lists = spark.createDataFrame(
        [(1, [10, 12, 11]), (2, [11]), (3, []), (4, [10])], "user_id bigint, predicted array<bigint>"
    )
    for users in ("common", "truth"):
        a = rankeval.ranking_metrics(lists, truth, 3, users)
        b = rankeval.array_metrics(lists, truth, 3, users)
        row = rankeval.metric_gap(a, b).first()
        assert row.n_users == (3 if users == "common" else 4) and row.gap < 1e-12
    other = rankeval.array_metrics(lists.where("user_id <> 2"), truth, 3)
    assert rankeval.metric_gap(a, other).first().gap >= 1
    nobody = lists.where("user_id > 99")
    gap = rankeval.metric_gap(rankeval.ranking_metrics(nobody, truth), rankeval.array_metrics(nobody, truth))
    assert gap.first().gap == 0


def test_tuning_recounts_its_lists(spark, bought):
    truth = bought.where("product_id % 3 = 0").select("user_id", "product_id")
    rows = als.tune_als(bought, truth, [(3, 0.1), (4, 0.1)], 5, recounted=True).collect()
    assert len(rows) == 2 and all(r.gap < 1e-12 and r.n_users > 10 for r in rows)


def test_lists_of_given_users_are_searched(spark, model, bought):
    """The lists of the model's own scoring, without a product of blocks of both sides."""
    some = spark.createDataFrame([(u,) for u in (*range(0, 60, 2), 4, 999, None)], "user_id bigint")
    lists = als.recommended_lists(model, 5, some)
    got = {r.user_id: r.predicted for r in lists.collect()}
    known = {r.id for r in model.userFactors.collect()}
    assert set(got) == {u for u in range(0, 60, 2) if u in known}
    own = als.recommend(model, 5, some)
    rows = lists.select("user_id", F.posexplode("predicted").alias("at", "product_id"))
    ranked = rows.withColumn("rank", F.col("at") + 1).join(
        als.recommend(model, 40, some).select("user_id", "product_id", "score"),
        ["user_id", "product_id"],
    )
    gaps = facts.list_gaps(ranked, own).collect()
    assert len(gaps) == len(got)
    assert all(r.n == r.n_other == 5 and r.n_different == 0 for r in gaps)
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_equal_scores_are_listed_by_id(spark):
    """Also where all products are one layer, which is not numbered first."""
    u, p = (
        spark.createDataFrame([(i, [1.0, 1.0]) for i in ids], FACTORS)
        for ids in (range(3), range(30, 0, -1))
    )
    rows = topk.search_best(u, p, 2, 4).rows.collect()
    assert sorted((r.user_id, r["rank"], r.product_id) for r in rows) == [
        (i, j, j) for i in range(3) for j in range(1, 5)
    ]


def test_a_recommender_keeps_its_ids(spark, bought, tmp_path):
    big = 1 << 33
    wide = bought.withColumns({c: F.col(c) * 3 + big for c in ("user_id", "product_id")})
    made = Recommender.fit(wide, rank=4, iterations=2)
    made.save(str(tmp_path / "a"))
    loaded = Recommender.load(spark, str(tmp_path / "a"))
    few = spark.createDataFrame([(big,), (big + 3,), (5,)], "user_id bigint")
    rows = loaded.recommend(4, few).collect()
    assert sorted((r.user_id, r["rank"]) for r in rows) == [(u, r) for u in (big, big + 3) for r in (1, 2, 3, 4)]
    assert all(r.product_id >= big and r.product_id % 3 == big % 3 for r in rows)
    assert loaded.recommend(4).where(F.col("user_id").isin(big, big + 3)).count() == 8
    novel = loaded.novel(wide, 5)
    assert novel.join(wide, ["user_id", "product_id"]).isEmpty()
    assert novel.select("user_id").distinct().count() == 60


def test_ids_of_another_model_are_refused(spark, bought, tmp_path):
    Recommender.fit(bought, rank=3, iterations=1).save(str(tmp_path / "a"))
    other = Recommender.fit(bought.where("user_id < 30"), rank=3, iterations=1)
    other.users.write.mode("overwrite").parquet(str(tmp_path / "a" / "user_ids"))
    with pytest.raises(ValueError, match="ids of another model"):
        Recommender.load(spark, str(tmp_path / "a"))
