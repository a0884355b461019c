"""Reading by header, the column contract, sinks, models and the whole pipeline."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketloom.operators import als, history, profile, reorder
from basketloom.plans import catalog, pipeline, serving
from basketloom.plans.pipeline import Config, run_manifest, run_pipeline
from basketloom.sources import durable as durable_module
from basketloom.sources import tables as src
from basketloom.sources.durable import delete, durable, fresh_path, publish, scope, shared_dir
from basketloom.sources.models import load_model, save_model
from basketloom.sources.schemas import TABLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    return catalog.event_tables(spark, SF_DIR)


def write(path, text):
    path.write_text(text, encoding="utf-8")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    write(
        tmp_path / "orders.csv",
        "user_id,order_id,days_since_prior_order,eval_set,order_number,order_dow,order_hour_of_day\n"
        "7,5000000000,,prior,1,2,08\n7,2,15.0,train,2,3,23\n",
    )
    df = src.read_table(spark, str(tmp_path / "orders.csv"), "csv", TABLES["orders"])
    assert df.schema == TABLES["orders"]
    assert [tuple(r) for r in df.orderBy("order_number").collect()] == [
        (5000000000, 7, "prior", 1, 2, 8), (2, 7, "train", 2, 3, 23)
    ]


def test_contract(spark, tmp_path):
    write(tmp_path / "orders.csv", "order_id,user_id,order_number,order_dow\n1,1,1,1\n")
    write(tmp_path / "aisles.csv", "aisle_id,aisle\n1,dairy\n")
    found = src.found_columns(spark, str(tmp_path))
    problems = {tuple(r) for r in src.schema_contract(spark, found).collect()}
    assert ("orders", "eval_set", "missing column") in problems
    assert ("orders", "order_hour_of_day", "missing column") in problems
    assert ("products", None, "missing table") in problems
    assert not [p for p in problems if p[0] == "aisles"]
    assert len(problems) == 2 + 4


@pytest.mark.parametrize("fmt", src.FORMATS)
def test_formats_keep_all_rows(spark, events, tmp_path, fmt):
    path = str(tmp_path)
    src.write_tables(events, path, fmt)
    back = src.load_tables(spark, path, fmt)
    assert src.schema_contract(spark, src.found_columns(spark, path, fmt)).isEmpty()
    for name, df in events.named().items():
        again = back.named()[name]
        assert again.schema.simpleString() == TABLES[name].simpleString()
        assert df.exceptAll(again).isEmpty() and again.exceptAll(df).isEmpty()


def test_other_formats_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="format"):
        src.load_tables(spark, str(tmp_path), "json")


def test_files_with_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "aisles.csv"
    folder.mkdir()
    write(folder / "a.csv", "aisle_id,aisle\n1,dairy\n")
    write(folder / "b.csv", "aisle,aisle_id\nfruit,2\n")
    with pytest.raises(Exception, match="header"):
        src.read_table(spark, str(folder), "csv", TABLES["aisles"]).collect()


def test_manifest(spark):
    row = run_manifest(spark, Config(max_user_id=5000)).first()
    assert (row.max_user_id, row.rank, row.reg, row.trees, row.threshold) == (5000, 20, 0.1, 50, 0.2)
    assert run_manifest(spark, Config()).first().max_user_id is None


def test_als_lists(spark):
    rows = als.recommend(catalog._als(spark, SF_DIR)).collect()
    per_user = {}
    for r in rows:
        per_user.setdefault(r.user_id, []).append(r)
    for items in per_user.values():
        items.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in items] == list(range(1, len(items) + 1))
        assert len(items) <= 10
        assert len({r.product_id for r in items}) == len(items)
        assert all(a.score >= b.score for a, b in zip(items, items[1:]))


def test_als_unknown_user_has_no_rows(spark):
    model = catalog._als(spark, SF_DIR)
    unknown = spark.createDataFrame([(10**6,)], "user_id bigint")
    assert als.recommend(model, 10, unknown).isEmpty()


def test_large_ids_are_indexed_and_restored(spark):
    bought = catalog._bought(spark, SF_DIR)
    wide = bought.withColumns(
        {"user_id": F.col("user_id") + 2**40, "product_id": F.col("product_id") * 2**33}
    )
    indexed, users, products = als.index_ids(wide)
    assert indexed.count() == bought.count()
    assert indexed.agg({"product_id": "max"}).first()[0] < 2**31
    rows = als.recommend(als.fit_als(indexed, rank=4, iterations=2), 3)
    back = als.restore_ids(rows, users, products)
    assert back.count() == rows.count()
    assert back.join(wide, "user_id", "left_anti").isEmpty()
    assert back.join(wide, "product_id", "left_anti").isEmpty()


def test_durable_tables_have_no_lineage(spark):
    df = durable(spark.range(10).withColumn("twice", F.col("id") * 2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Range" not in plan
    assert df.agg(F.sum("twice")).first()[0] == 90


def test_novel_lists_do_not_repeat_purchases(spark):
    bought = catalog._bought(spark, SF_DIR)
    novel = als.novel(catalog._als(spark, SF_DIR), bought)
    assert novel.join(bought, ["user_id", "product_id"]).isEmpty()


def test_few_users_do_not_shuffle_the_lines(spark, events):
    few = spark.createDataFrame([(3,), (4,), (10**6,)], "user_id bigint")
    own = serving.tables_of(events, few)
    df = history.history(own.prior, history.orders_in(own.orders, "prior"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    got = serving.user_profiles(events, few)
    want = profile.customer_profile(events).where("user_id IN (3, 4)")
    assert got.count() == 2 and got.exceptAll(want).isEmpty()


def test_user_answers_agree_with_all_users(spark, events):
    few = spark.createDataFrame([(3,), (4,), (10**6,)], "user_id bigint")
    forest = catalog._forest(spark, SF_DIR)
    some = serving.user_reorders(events, forest, few, threshold=0.0)
    every = reorder.reorder_predictions(events, forest, threshold=0.0)
    assert some.exceptAll(every.where("user_id IN (3, 4)")).isEmpty()
    assert every.where("user_id IN (3, 4)").exceptAll(some).isEmpty()
    named = serving.user_recommendations(events, catalog._recommender(spark, SF_DIR), few)
    assert {r.user_id for r in named.select("user_id").distinct().collect()} == {3, 4}


def test_als_model_survives_saving(spark, tmp_path):
    model = catalog._als(spark, SF_DIR)
    save_model(model, str(tmp_path / "als"))
    again = load_model("als", str(tmp_path / "als"))
    a, b = (als.recommend(m, 5).orderBy("user_id", "rank").toPandas() for m in (model, again))
    assert a.equals(b)


def test_forest_survives_saving(spark, tmp_path):
    model = catalog._forest(spark, SF_DIR)
    save_model(model, str(tmp_path / "forest"))
    again = load_model("reorder", str(tmp_path / "forest"))
    data = catalog._dataset(spark, SF_DIR)
    keep = ["user_id", "product_id", "probability"]
    a, b = (reorder.score_reorder(m, data).select(keep) for m in (model, again))
    assert a.exceptAll(b).isEmpty()


def test_grid_is_ordered_by_ndcg(spark):
    bought, truth = catalog._bought(spark, SF_DIR), catalog._truth(spark, SF_DIR)
    rows = als.tune_als(bought, truth, [(5, 0.05), (5, 0.1)]).collect()
    assert sorted(r.position for r in rows) == [0, 1]
    assert rows[0].ndcg >= rows[1].ndcg
    assert all(0 <= r.precision <= 1 and r.n_users > 0 for r in rows)


def test_pipeline(spark, events, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    src.write_tables(events, source, "csv")
    run_pipeline(spark, source, target, config=Config(trees=5, iterations=2))
    read = spark.read.parquet
    stats = spark.read.json(f"{target}/dashboard/stats").first()
    assert stats.orders == events.orders.count()
    hours = spark.read.json(f"{target}/dashboard/orders_by_hour")
    assert hours.agg(F.sum("n_orders")).first()[0] == stats.orders
    popular = spark.read.csv(f"{target}/popularity", header=True)
    assert popular.columns == ["product_id", "product_name", "n"] and popular.count() <= 100
    assert {r.model for r in read(f"{target}/model_comparison").collect()} == {"popularity", "als"}
    assert read(f"{target}/threshold_sweep").count() == 13
    assert read(f"{target}/reorder_quality").count() == 1
    assert read(f"{target}/customer_profile").count() > 0
    assert read(f"{target}/reorder_predictions").where("probability < 0.2").isEmpty()
    assert read(f"{target}/runs").count() == 1
    assert load_model("als", f"{target}/models/als").rank == 20
    assert load_model("reorder", f"{target}/models/reorder").getNumTrees == 5


def test_pipeline_refuses_incomplete_input(spark, tmp_path):
    with pytest.raises(ValueError, match="missing table"):
        run_pipeline(spark, str(tmp_path), str(tmp_path / "out"))


def files_in(path):
    return sorted(p.name for p in path.iterdir() if not p.name.startswith("."))


def test_a_scope_deletes_its_tables(spark):
    with pytest.raises(ZeroDivisionError), scope(spark) as outer:
        df = durable(spark.range(5))
        assert df.inputFiles()[0].startswith(f"file://{outer.removeprefix('file:')}/")
        with scope(spark) as inner:
            assert durable(spark.range(3), "inner").count() == 3
            assert inner.startswith(outer)
        assert df.count() == 5
        1 / 0
    for path in (inner, outer):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(path)
    assert not fresh_path(spark, "x").startswith(outer)
    delete(spark, outer)  # there is none any more


def test_results_are_replaced_together(spark, tmp_path):
    new, target = tmp_path / "out" / "run-1", tmp_path / "out"
    for path, n in ((target / "a", 1), (new / "a", 2), (new / "b", 2), (target / "kept", 1)):
        spark.range(n).write.parquet(str(path))
    publish(spark, str(new), str(target))
    assert [spark.read.parquet(f"{target}/{n}").count() for n in ("a", "b", "kept")] == [2, 2, 1]
    assert files_in(new) == [] and files_in(target) == ["a", "b", "kept", "run-1"]


def made_tables(spark, n_users=60):
    """Four orders of each user, the last one the next order; three of ten products in each."""
    orders = [(4 * u + i, u, "train" if i == 4 else "prior", i, u % 7, u % 24)
              for u in range(n_users) for i in range(1, 5)]
    lines = [(o, (u * i + j) % 10, j + 1, int(i > 1), split)
             for o, u, split, i, *_ in orders for j in range(3)]
    names = ("orders", "order_products__prior", "order_products__train", "products", "aisles", "departments")
    rows = (
        orders, [r[:4] for r in lines if r[4] == "prior"], [r[:4] for r in lines if r[4] == "train"],
        [(p, f"p{p}", 1, 1) for p in range(10)], [(1, "a")], [(1, "d")],
    )
    return src.Tables(*(spark.createDataFrame(r, src.TABLES[n]) for n, r in zip(names, rows)))


def test_a_run_scores_what_it_judges_and_predicts(spark, tmp_path, monkeypatch):
    """Validation and test rows once, then every pair; training rows are judged by no result."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    tables = made_tables(spark)
    src.write_tables(tables, source, "csv")
    scored, score = [], reorder.score_reorder

    def recorded(model, df):
        scored.append((sorted(r.split for r in df.select("split").distinct().collect())
                       if "split" in df.columns else "all", df.count()))
        return score(model, df)

    monkeypatch.setattr(reorder, "score_reorder", recorded)
    run_pipeline(spark, source, target, config=Config(trees=2, depth=2, rank=2, iterations=1))
    pairs = tables.prior.join(tables.orders, "order_id").select("user_id", "product_id").distinct()
    assert [kind for kind, _ in scored] == [["test", "validation"], "all"]
    assert scored[1][1] == pairs.count() and 0 < scored[0][1] < pairs.count()
    quality = spark.read.parquet(f"{target}/reorder_quality").first()
    sweep = spark.read.parquet(f"{target}/threshold_sweep").first()
    cells = [sum(row[c] for c in ("tp", "fp", "fn", "tn")) for row in (quality, sweep)]
    assert sum(cells) == scored[0][1]


def test_a_failed_replacement_is_undone(spark, tmp_path, monkeypatch):
    new, target = tmp_path / "out" / "run-1", tmp_path / "out"
    for path, n in ((target / "a", 1), (target / "b", 1), (new / "a", 2), (new / "b", 2)):
        spark.range(n).write.parquet(str(path))
    files, make = durable_module._file_system(spark, str(target))

    class Failing:
        renamed = 0

        def __getattr__(self, name):
            return getattr(files, name)

        def rename(self, source, goal):
            self.renamed += 1
            return self.renamed != 4 and files.rename(source, goal)

    monkeypatch.setattr(durable_module, "_file_system", lambda *_: (Failing(), make))
    with pytest.raises(OSError):
        publish(spark, str(new), str(target))
    assert [spark.read.parquet(f"{target}/{n}").count() for n in ("a", "b")] == [1, 1]
    assert [spark.read.parquet(f"{new}/{n}").count() for n in ("a", "b")] == [2, 2]


def test_a_broken_run_leaves_the_results_before_it(spark, events, tmp_path, monkeypatch):
    source, target = str(tmp_path / "in"), tmp_path / "out"
    src.write_tables(events, source, "csv")
    config = Config(trees=2, depth=2, rank=2, iterations=1)
    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = files_in(shared)
    run_pipeline(spark, source, str(target), config=config)
    names = files_in(target)
    profiles = spark.read.parquet(f"{target}/customer_profile").count()

    def broken(*args, **settings):
        raise RuntimeError("no forest")

    monkeypatch.setattr(pipeline.reorder, "fit_reorder", broken)
    with pytest.raises(RuntimeError, match="no forest"):
        run_pipeline(spark, source, str(target), config=config)
    monkeypatch.undo()
    assert files_in(target) == names
    assert spark.read.parquet(f"{target}/customer_profile").count() == profiles
    assert spark.read.parquet(f"{target}/runs").count() == 1
    run_pipeline(spark, source, str(target), config=config)
    assert files_in(target) == names and spark.read.parquet(f"{target}/runs").count() == 2
    # Only what the factorisation checkpoints is left of three runs.
    assert [n for n in files_in(shared) if n not in before and "-" in n and n.startswith("scope")] == []
