"""Every operator as a query over a folder of test tables.

Statistics and history run on the sales tables, everything about repeated
purchases on the events (see ``sources.adapters``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields
from functools import reduce
from operator import add

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.operators import als, alscheck, classeval, forest, history, popularity, profile
from basketloom.operators import rankeval
from basketloom.operators import recommend as lists
from basketloom.operators import reorder, stats
from basketloom.operators.names import with_product_names
from basketloom.operators.recommender import Recommender
from basketloom.plans import facts
from basketloom.plans.experiments import tune_on_last_order
from basketloom.plans.pipeline import popularity_sink, run_pipeline, write_dashboard
from basketloom.plans.serving import user_profiles, user_recommendations, user_reorders
from basketloom.sources.adapters import ADAPTERS
from basketloom.sources.durable import durable, fresh_path
from basketloom.sources.models import load_model, save_model
from basketloom.sources.tables import Tables, load_tables, write_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

_made: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[], object]) -> object:
    """Tables, inputs or a model made once per session and folder, for all its queries."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def _tables(spark: SparkSession, sf_dir: str, kind: str) -> Tables:
    return _once(
        spark, sf_dir, kind, lambda: ADAPTERS[kind](spark, sf_dir, fresh_path(spark, kind))
    )


def sales_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return _tables(spark, sf_dir, "sales")


def event_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return _tables(spark, sf_dir, "events")


def _on_sales(name: str) -> Callable[[Callable[[Tables], DataFrame]], None]:
    def register(build: Callable[[Tables], DataFrame]) -> None:
        QUERIES[name] = lambda spark, sf_dir: build(sales_tables(spark, sf_dir))

    return register


def _on_events(name: str) -> Callable[[Callable[[Tables], DataFrame]], None]:
    def register(build: Callable[[Tables], DataFrame]) -> None:
        QUERIES[name] = lambda spark, sf_dir: build(event_tables(spark, sf_dir))

    return register


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means depend on the order of summation in their last digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Statistics

_on_sales("table_counts")(stats.table_counts)
_on_sales("dashboard_stats")(stats.dashboard_stats)
_on_events("dashboard_stats_events")(stats.dashboard_stats)
_on_sales("unique_users")(lambda t: stats.unique_users(t.orders))
_on_sales("avg_basket")(lambda t: _rounded(stats.avg_basket(t.prior), "basket"))
_on_events("reorder_rate")(lambda t: _rounded(stats.reorder_rate(t.prior), "reorder_rate"))
_on_sales("orders_by_dow")(lambda t: stats.orders_by_dow(t.orders))
_on_events("orders_by_hour")(lambda t: stats.orders_by_hour(t.orders))
_on_sales("product_counts")(lambda t: stats.product_counts(t.prior))
_on_sales("top_products")(lambda t: stats.top_products(stats.product_counts(t.prior), t.products))
_on_sales("popularity_table")(popularity.popularity_table)

# History

_on_sales("cohort_filter")(lambda t: history.orders_in(t.orders, "prior"))
_on_sales("cohort_users")(lambda t: history.cohort_users(t.orders))
_on_sales("join_lines_orders")(
    lambda t: history.history(t.prior, history.orders_in(t.orders, "prior"))
)
_on_sales("interactions")(lambda t: history.interactions(t.orders, t.prior))
_on_events("interactions_events")(lambda t: history.interactions(t.orders, t.prior))
_on_sales("join_restrict_users")(
    lambda t: history.interactions(t.orders, t.prior, users=history.orders_in(t.orders, "train"))
)
_on_sales("purchase_history")(history.purchase_history)
_on_events("purchase_history_events")(history.purchase_history)
_on_sales("ranked_history")(history.ranked_history)
_on_events("ranked_history_events")(history.ranked_history)
_on_sales("next_order")(history.next_order)
_on_sales("actual_sets")(lambda t: history.actual_sets(t.orders, t.train))
_on_sales("last_order_per_user")(
    lambda t: history.last_orders(history.orders_in(t.orders, "prior"))
)


@_on_sales("leave_last_order_out")
def _leave_last_order_out(t: Tables) -> DataFrame:
    labelled = history.orders_in(t.orders, "train")
    return history.leave_last_order_out(history.orders_in(t.orders, "prior", users=labelled))


# Customers


def _prior_lines(t: Tables) -> DataFrame:
    return history.history(t.prior, history.orders_in(t.orders, "prior"))


_on_events("customer_profile")(profile.customer_profile)
_on_sales("customer_profile_sales")(profile.customer_profile)
_on_sales("user_profiles")(
    lambda t: user_profiles(t, history.orders_in(t.orders, "train"))
)
_on_events("basic_customer_aggs")(
    lambda t: _rounded(
        profile.basic_customer_aggs(history.user_products(_prior_lines(t))), "reorder_rate"
    )
)


@_on_events("favourite_counts")
def _favourite_counts(t: Tables) -> DataFrame:
    orders = history.orders_in(t.orders, "prior")
    counts = profile.favourite_counts(
        orders, ["order_dow", "order_hour_of_day"], [F.count("*").alias("n")]
    )
    return counts.select("user_id", "order_dow", "order_hour_of_day", "n")


@_on_events("top1_per_user")
def _top1_per_user(t: Tables) -> DataFrame:
    counts = history.interactions(t.orders, t.prior)
    best = lists.topk_per_user(counts, [F.desc("purchases"), F.asc("product_id")], 1)
    return best.select("user_id", "product_id", "purchases")


# Popularity and ranking metrics


def _popular(t: Tables, k: int = 10) -> DataFrame:
    return popularity.popularity_recommendations(
        stats.product_counts(_prior_lines(t)), history.cohort_users(t.orders), k
    )


_on_events("popularity_recommendations")(lambda t: lists.list_rows(_popular(t)))
_on_events("novel_recommendations")(
    lambda t: popularity.novel_popular(
        stats.product_counts(_prior_lines(t)),
        history.cohort_users(t.orders),
        history.interactions(t.orders, t.prior),
    )
)
_on_events("ranking_metrics")(
    lambda t: _rounded(
        rankeval.ranking_metrics(_popular(t), history.next_order_lines(t.orders, t.train)),
        "precision", "recall", "ndcg",
    )
)
_on_sales("ranking_metrics_sales")(
    lambda t: _rounded(
        rankeval.ranking_metrics(_popular(t), history.next_order_lines(t.orders, t.train)),
        "precision", "recall", "ndcg",
    )
)
_on_events("user_metrics")(
    lambda t: _rounded(
        rankeval.user_metrics(_popular(t), history.next_order_lines(t.orders, t.train)),
        "precision", "recall", "ndcg",
    )
)


@_on_events("compare_models")
def _compare_models(t: Tables) -> DataFrame:
    """Popular products against each user's own most bought ones."""
    truth = history.next_order_lines(t.orders, t.train)
    own = lists.topk_per_user(
        history.interactions(t.orders, t.prior), [F.desc("purchases"), F.asc("product_id")], 10
    )
    candidates = {"popular": _popular(t), "own": lists.rows_as_lists(own)}
    metrics = {
        name: _rounded(
            rankeval.ranking_metrics(predicted, truth, users="truth"),
            "precision", "recall", "ndcg",
        )
        for name, predicted in candidates.items()
    }
    return rankeval.compare_models(metrics)


@_on_events("topk_per_user")
def _topk_per_user(t: Tables) -> DataFrame:
    rates = reorder.reorder_features(t.orders, t.prior).withColumnRenamed("purchase_rate", "score")
    best = lists.topk_per_user(rates, [F.desc("score"), F.asc("product_id")], 10)
    return lists.recommend_named(best, t.products)


@_on_sales("join_names_fallback")
def _join_names_fallback(t: Tables) -> DataFrame:
    return with_product_names(stats.product_counts(t.prior), t.products, "left")


# Reorder model: its data, and its evaluation with the purchase rate as score


def _with_score(t: Tables) -> DataFrame:
    dataset = reorder.reorder_dataset(t.orders, t.prior, t.train)
    return dataset.withColumnRenamed("purchase_rate", "probability")


_on_events("user_product_aggs")(
    lambda t: _rounded(history.user_products(_prior_lines(t)), "avg_cart_position")
)
_on_events("reorder_features")(
    lambda t: _rounded(
        reorder.reorder_features(t.orders, t.prior), "avg_cart_position", "purchase_rate"
    )
)
_on_sales("reorder_features_sales")(
    lambda t: _rounded(
        reorder.reorder_features(t.orders, t.prior), "avg_cart_position", "purchase_rate"
    )
)
_on_events("reorder_dataset")(
    lambda t: _rounded(
        reorder.reorder_dataset(t.orders, t.prior, t.train), "avg_cart_position", "purchase_rate"
    )
)
_on_events("reorder_dataset_all_users")(
    lambda t: _rounded(
        reorder.reorder_dataset(t.orders, t.prior, t.train, labelled_only=False),
        "avg_cart_position", "purchase_rate",
    )
)
_on_sales("split_users")(lambda t: reorder.split_users(history.cohort_users(t.orders)))
_on_events("confusion")(lambda t: classeval.confusion(_with_score(t), reorder.THRESHOLD))
_on_events("threshold_sweep")(
    lambda t: _rounded(
        classeval.threshold_sweep(_with_score(t)), "precision", "recall", "f1", "accuracy"
    )
)
_on_events("threshold_sweep_wide")(
    lambda t: _rounded(
        classeval.threshold_sweep(_with_score(t), classeval.WIDE_THRESHOLDS),
        "precision", "recall", "f1", "accuracy",
    )
)
_on_events("best_threshold")(
    lambda t: _rounded(classeval.best_threshold(classeval.threshold_sweep(_with_score(t))), "f1")
)


@_on_events("holdout_eval")
def _holdout_eval(t: Tables) -> DataFrame:
    held = reorder.split_users(_with_score(t)).where(F.col("split") == "test")
    return _rounded(
        classeval.classification_metrics(held, reorder.THRESHOLD),
        "precision", "recall", "f1", "accuracy",
    )


@_on_events("rate_reorder_list")
def _rate_reorder_list(t: Tables) -> DataFrame:
    features = reorder.reorder_features(t.orders, t.prior)
    return reorder.reorder_list(
        features.withColumn("probability", F.col("purchase_rate")), t.products
    )


# Sources and sinks: written by Spark to the shared folder and read back


def _scan(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """Rows, sum of all numbers and length of all texts of each table read back."""
    path = fresh_path(spark, fmt)
    write_tables(event_tables(spark, sf_dir), path, fmt)
    loaded = load_tables(spark, path, fmt)
    sums = []
    for field in fields(loaded):
        df = getattr(loaded, field.name)
        kinds = dict(df.dtypes)
        numbers = [F.sum(F.col(c).cast("bigint")) for c, kind in kinds.items() if kind != "string"]
        texts = [F.sum(F.length(c)).cast("bigint") for c, kind in kinds.items() if kind == "string"]
        sums.append(
            df.agg(
                F.lit(field.name).alias("table_name"),
                F.count("*").alias("n_rows"),
                reduce(add, numbers).alias("numbers"),
                (reduce(add, texts) if texts else F.lit(0).cast("bigint")).alias("characters"),
            )
        )
    return reduce(DataFrame.union, sums)


def _popularity_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "popularity")
    popularity_sink(sales_tables(spark, sf_dir), path)
    return spark.read.csv(
        path, header=True, schema="product_id bigint, product_name string, n bigint"
    )


def _dashboard_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four tables read back, as rows of table, key, name and value."""
    path = fresh_path(spark, "dashboard")
    write_dashboard(event_tables(spark, sf_dir), path)

    def back(name: str, schema: str, rows: str) -> DataFrame:
        read = spark.read.json(f"{path}/{name}", schema=schema)
        return read.selectExpr(f"'{name}' AS part", rows)

    counts = ["orders", "users", "products", "interactions", "reorder_rate", "basket"]
    stacked = ", ".join(f"0L, '{c}', CAST({c} AS DOUBLE)" for c in counts)
    as_row = "stack(1, CAST({} AS BIGINT), {}, CAST({} AS DOUBLE)) AS (key, name, value)"
    hist = "{} int, n_orders bigint"
    return reduce(
        DataFrame.union,
        [
            back("stats", ", ".join(f"{c} double" for c in counts),
                 f"stack({len(counts)}, {stacked}) AS (key, name, value)"),
            back("top_products", "product_id bigint, product_name string, n bigint",
                 as_row.format("product_id", "product_name", "n")),
            *(
                back(name, hist.format(key), as_row.format(key, "''", "n_orders"))
                for name, key in (("orders_by_hour", "order_hour_of_day"), ("orders_by_dow", "order_dow"))
            ),
        ],
    )


QUERIES["scan_csv"] = lambda spark, sf_dir: _scan(spark, sf_dir, "csv")
QUERIES["scan_parquet"] = lambda spark, sf_dir: _scan(spark, sf_dir, "parquet")
QUERIES["scan_orc"] = lambda spark, sf_dir: _scan(spark, sf_dir, "orc")
QUERIES["popularity_sink"] = _popularity_sink
QUERIES["dashboard_sink"] = _dashboard_sink


# Fitted models: the result depends on the fit, so these return what holds for any fit
# (see ``plans.facts``), from all rows of the whole result


def _bought(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        t = event_tables(spark, sf_dir)
        return durable(history.interactions(t.orders, t.prior))

    return _once(spark, sf_dir, "interactions", make)


def _truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        t = event_tables(spark, sf_dir)
        return durable(history.actual_sets(t.orders, t.train))

    return _once(spark, sf_dir, "truth", make)


def _als(spark: SparkSession, sf_dir: str) -> ALSModel:
    return _once(spark, sf_dir, "als", lambda: als.fit_als(_bought(spark, sf_dir)))


def _dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        t = event_tables(spark, sf_dir)
        dataset = reorder.reorder_dataset(t.orders, t.prior, t.train)
        weights = {"train": 0.7, "validation": 0.15, "test": 0.15}
        return durable(reorder.split_users(dataset, weights))

    return _once(spark, sf_dir, "dataset", make)


def _forest(spark: SparkSession, sf_dir: str) -> RandomForestClassificationModel:
    return _once(
        spark, sf_dir, "forest",
        lambda: reorder.fit_reorder(_dataset(spark, sf_dir).where(F.col("split") == "train")),
    )


def prepare_steps(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], object]]:
    """What queries share, in the order it is to be made."""
    return {
        "sales_tables": lambda: sales_tables(spark, sf_dir),
        "event_tables": lambda: event_tables(spark, sf_dir),
        "interactions": lambda: _bought(spark, sf_dir),
        "truth": lambda: _truth(spark, sf_dir),
        "als": lambda: _als(spark, sf_dir),
        "dataset": lambda: _dataset(spark, sf_dir),
        "forest": lambda: _forest(spark, sf_dir),
    }


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_tables(spark, sf_dir).products


def _scored(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    rows = _dataset(spark, sf_dir).where(F.col("split") == split)
    return reorder.score_reorder(_forest(spark, sf_dir), rows)


def _all_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "all lists", lambda: als.recommend(_als(spark, sf_dir)))


def _novel_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "novel lists",
        lambda: als.novel(_als(spark, sf_dir), _bought(spark, sf_dir)),
    )


def _loaded_als(spark: SparkSession, sf_dir: str) -> ALSModel:
    path = fresh_path(spark, "als")
    save_model(_als(spark, sf_dir), path)
    return load_model("als", path)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truth(spark, sf_dir).select("user_id").distinct()


def _als_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        return durable(
            als.recommended_lists(_als(spark, sf_dir), 10, _labelled(spark, sf_dir)), "lists"
        )

    return _once(spark, sf_dir, "als lists", make)


def _model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of both models; those of the factors only as being rates."""
    truth = _truth(spark, sf_dir)
    popular = _popular(event_tables(spark, sf_dir))
    compared = rankeval.compare_models(
        {
            "popularity": rankeval.ranking_metrics(popular, truth, users="truth"),
            "als": rankeval.ranking_metrics(_als_lists(spark, sf_dir), truth, users="truth"),
        }
    )
    return compared.select(
        "model",
        "n_users",
        *[F.when(F.col("model") == "popularity", F.round(c, 6)).alias(c) for c in RANKING],
        facts.in_bounds(*RANKING),
    )


RANKING = ["precision", "recall", "ndcg"]
RATES = ["precision", "recall", "accuracy", "f1"]


def _cell_facts(metrics: DataFrame, *keys: str) -> DataFrame:
    """Rows of either label behind a row of counts and rates."""
    return metrics.select(
        *keys,
        (F.col("tp") + F.col("fn")).alias("n_positive"),
        (F.col("fp") + F.col("tn")).alias("n_negative"),
        facts.in_bounds(*RATES),
    )


def _rf_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    likely = F.col("probability") > 0.5
    unsure = F.abs(F.col("probability") - 0.5) < 1e-9
    return _scored(spark, sf_dir, "test").select(
        "user_id", "product_id", "label", facts.in_bounds("probability"),
        (unsure | (likely == (F.col("prediction") == 1))).alias("agrees"),
    )


def _reorder_facts(spark: SparkSession, sf_dir: str, users: DataFrame | None) -> DataFrame:
    t, forest = event_tables(spark, sf_dir), _forest(spark, sf_dir)
    scored = reorder.score_reorder(
        forest, reorder.reorder_features(t.orders, t.prior, users=users)
    )
    found = (
        reorder.reorder_predictions(t, forest) if users is None else user_reorders(t, forest, users)
    )
    return facts.reorder_facts(found, scored, t.products, reorder.THRESHOLD)


def _run_folder(spark: SparkSession, sf_dir: str) -> str:
    """The results of a whole run, from CSV."""

    def make() -> str:
        source, target = fresh_path(spark, "source"), fresh_path(spark, "run")
        write_tables(event_tables(spark, sf_dir), source, "csv")
        run_pipeline(spark, source, target)
        return target

    return _once(spark, sf_dir, "run", make)


def _full_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run from CSV to result tables; of these the profiles."""
    return spark.read.parquet(f"{_run_folder(spark, sf_dir)}/customer_profile")


def _pipeline_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every table the whole run writes: rows, a sum, and rows that cannot be right.

    The sum is of numbers that no fit changes. Where the number of rows depends on the
    fit it is left out, and what is wrong with any row is counted.
    """
    path = _run_folder(spark, sf_dir)

    def table(name: str, numbers: str, wrong: str = "false", fmt: str = "parquet",
              schema: str | None = None, counted: bool = True) -> DataFrame:
        reader = spark.read.schema(schema) if schema else spark.read
        options = {"header": True} if fmt == "csv" else {}
        rows = reader.options(**options).format(fmt).load(f"{path}/{name}")
        return rows.selectExpr(
            f"'{name}' AS part", "count(*) AS n_rows" if counted else "CAST(NULL AS bigint) AS n_rows",
            f"CAST(sum({numbers}) AS bigint) AS numbers",
            f"count_if(coalesce({wrong}, true)) AS n_wrong",
        )

    unlike = "NOT (precision BETWEEN 0 AND 1 AND recall BETWEEN 0 AND 1 AND {} BETWEEN 0 AND 1)"
    return reduce(
        DataFrame.union,
        [
            table("dashboard/stats", "orders + users + products + interactions", fmt="json"),
            table("dashboard/top_products", "n", "product_name IS NULL", "json"),
            table("dashboard/orders_by_hour", "n_orders", fmt="json"),
            table("dashboard/orders_by_dow", "n_orders", fmt="json"),
            table("popularity", "n", "product_name IS NULL", "csv",
                  "product_id bigint, product_name string, n bigint"),
            table("customer_profile", "purchases"),
            table("recommendations", "rank", "rank NOT BETWEEN 1 AND 10 OR product_name IS NULL"),
            table("model_comparison", "n_users", unlike.format("ndcg")),
            table("threshold_sweep", "tp + fn", unlike.format("f1")),
            table("reorder_quality", "tp + fn", unlike.format("f1")),
            table("reorder_predictions", "0", counted=False,
                  wrong="rank NOT BETWEEN 1 AND 10 OR probability < 0.2 OR product_name IS NULL"),
            table("models/user_ids", "user_id", "dense_id < 0"),
            table("models/product_ids", "product_id", "dense_id < 0"),
            table("runs", "k", "completed_at > current_timestamp()"),
        ],
    ).fillna(0, ["numbers"])


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "grid",
        lambda: durable(tune_on_last_order(event_tables(spark, sf_dir), recounted=True), "grid"),
    )


def _recommender(spark: SparkSession, sf_dir: str) -> Recommender:
    """A model with its ids, saved and loaded."""

    def make() -> Recommender:
        path = fresh_path(spark, "recommender")
        Recommender.fit(_bought(spark, sf_dir)).save(path)
        return Recommender.load(spark, path)

    return _once(spark, sf_dir, "recommender", make)


def _large_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of a model fitted on ids beyond 32 bits, saved, loaded and asked by such ids."""
    wide = durable(
        _bought(spark, sf_dir).withColumns(
            {c: F.col(c) + F.lit(1 << 33) for c in ("user_id", "product_id")}
        ),
        "wide",
    )
    path = fresh_path(spark, "recommender")
    Recommender.fit(wide, rank=5, iterations=2).save(path)
    users = wide.select("user_id").distinct()
    rows = Recommender.load(spark, path).recommend(10, users)
    return facts.list_facts(rows, wide)


def _metrics_recounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of lists counted row by row against the same lists judged as arrays."""
    truth = _truth(spark, sf_dir)
    lists_of = {
        "popularity": durable(_popular(event_tables(spark, sf_dir)), "lists"),
        "als": _als_lists(spark, sf_dir),
    }
    rows = [
        rankeval.metric_gap(
            rankeval.ranking_metrics(predicted, truth, users=users),
            rankeval.array_metrics(predicted, truth, users=users),
        ).select(
            F.lit(model).alias("model"), F.lit(users).alias("users"), "n_users",
            (F.col("gap") < 1e-9).alias("same"),
        )
        for model, predicted in lists_of.items()
        for users in ("common", "truth")
    ]
    return reduce(DataFrame.union, rows)


def _walked(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    """Scores of the model beside those of its nodes."""
    nodes = _once(spark, sf_dir, "nodes", lambda: forest.forest_table(_forest(spark, sf_dir)))
    return forest.walk(nodes, _scored(spark, sf_dir, split))


def _rf_fit_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dataset(spark, sf_dir).where(F.col("split") == "train")
    model = reorder.fit_reorder(rows, trees=10, sampled=False)
    return forest.fit_check(forest.forest_table(model), rows).drop("n_nodes")


def _rf_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluations' cells against counts of the scores that the nodes give."""
    scored, walked = _scored(spark, sf_dir, "test"), durable(_walked(spark, sf_dir, "test"), "walked")
    return reduce(
        DataFrame.union,
        [
            facts.cells_gap(
                classeval.classification_metrics(scored, threshold),
                walked.select("label", (test).alias("positive")), name,
            )
            for name, threshold, test in (
                ("rf_default_eval", None, F.col("walked") > 0.5),
                ("rf_holdout", reorder.THRESHOLD, F.col("walked") >= reorder.THRESHOLD),
            )
        ],
    )


def _als_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _als(spark, sf_dir)
    return alscheck.user_optimality(
        model.userFactors, model.itemFactors, _bought(spark, sf_dir), model.rank
    ).drop("gap")


def _als_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounded search against the model's own scoring of all pairs."""
    model = _als(spark, sf_dir)
    every = model.userFactors.select(F.col("id").alias("user_id"))
    return facts.list_gaps(_all_lists(spark, sf_dir), als.recommend(model, 10, every))


QUERIES["als_optimality"] = _als_optimality
QUERIES["als_search"] = _als_search
QUERIES["als_grid_recounted"] = lambda spark, sf_dir: _grid(spark, sf_dir).select(
    "position", "n_users", (F.col("gap") < 1e-9).alias("same")
)
QUERIES["metrics_recounted"] = _metrics_recounted
QUERIES["recommender_large_ids"] = _large_ids
QUERIES["rf_walked"] = lambda spark, sf_dir: _walked(spark, sf_dir, "test").select(
    "user_id", "product_id",
    (F.abs(F.col("probability") - F.col("walked")) <= forest.TOLERANCE).alias("equal"),
)
QUERIES["rf_fit_check"] = _rf_fit_check
QUERIES["rf_cells_recounted"] = _rf_cells
QUERIES["pipeline_tables"] = _pipeline_tables
QUERIES["als_fit"] = lambda spark, sf_dir: facts.factor_facts(_als(spark, sf_dir))
QUERIES["als_recommend_all"] = lambda spark, sf_dir: facts.list_facts(
    _all_lists(spark, sf_dir), _bought(spark, sf_dir)
)
QUERIES["als_recommend_subset"] = lambda spark, sf_dir: facts.list_facts(
    als.recommend(_loaded_als(spark, sf_dir), 10, _labelled(spark, sf_dir)),
    _bought(spark, sf_dir),
)
QUERIES["als_named"] = lambda spark, sf_dir: facts.list_facts(
    lists.recommend_named(_all_lists(spark, sf_dir), _products(spark, sf_dir)),
    _bought(spark, sf_dir),
    _products(spark, sf_dir),
)
QUERIES["als_novel"] = lambda spark, sf_dir: facts.novel_facts(
    _novel_lists(spark, sf_dir), _bought(spark, sf_dir)
)
QUERIES["als_novel_counts"] = lambda spark, sf_dir: (
    _novel_lists(spark, sf_dir)
    .groupBy("user_id")
    .agg(F.count("*").alias("n"), F.max("rank").alias("last_rank"))
)
QUERIES["als_metrics"] = lambda spark, sf_dir: rankeval.ranking_metrics(
    _als_lists(spark, sf_dir), _truth(spark, sf_dir)
).select("n_users", facts.in_bounds(*RANKING))
QUERIES["als_grid"] = lambda spark, sf_dir: _grid(spark, sf_dir).select(
    "position", "rank", "reg", "n_users", facts.in_bounds(*RANKING)
)
QUERIES["model_comparison"] = _model_comparison
QUERIES["rf_scores"] = _rf_scores
QUERIES["rf_default_eval"] = lambda spark, sf_dir: _cell_facts(
    classeval.classification_metrics(_scored(spark, sf_dir, "test"))
)
QUERIES["rf_threshold_sweep"] = lambda spark, sf_dir: _cell_facts(
    classeval.threshold_sweep(_scored(spark, sf_dir, "validation")), "threshold"
)
QUERIES["rf_holdout"] = lambda spark, sf_dir: _cell_facts(
    classeval.classification_metrics(_scored(spark, sf_dir, "test"), reorder.THRESHOLD)
)
QUERIES["reorder_predictions"] = lambda spark, sf_dir: _reorder_facts(spark, sf_dir, None)
QUERIES["user_recommendations"] = lambda spark, sf_dir: facts.list_facts(
    user_recommendations(
        event_tables(spark, sf_dir), _recommender(spark, sf_dir), _labelled(spark, sf_dir)
    ),
    _bought(spark, sf_dir),
    _products(spark, sf_dir),
)
QUERIES["user_reorders"] = lambda spark, sf_dir: _reorder_facts(
    spark, sf_dir, _labelled(spark, sf_dir)
)
QUERIES["full_pipeline"] = _full_pipeline
