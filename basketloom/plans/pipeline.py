"""The whole run as one Spark job: statistics, both models and their results."""

from __future__ import annotations

import argparse
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.operators import als, classeval, reorder
from basketloom.operators.history import actual_sets, history, orders_in, user_products
from basketloom.operators.popularity import popularity_recommendations
from basketloom.operators.profile import customer_profile
from basketloom.operators.rankeval import compare_models, ranking_metrics
from basketloom.operators.recommend import recommend_named, rows_as_lists
from basketloom.operators.stats import (
    dashboard_stats,
    orders_by_dow,
    orders_by_hour,
    product_counts,
    top_products,
)
from basketloom.operators.recommender import Recommender
from basketloom.sources.durable import delete, durable, fresh_path, publish, scope
from basketloom.sources.models import save_model
from basketloom.sources.tables import (
    FORMATS,
    Tables,
    found_columns,
    load_tables,
    schema_contract,
    write_table,
    write_tables,
)


@dataclass(frozen=True)
class Config:
    """Settings of a run; ``max_user_id`` bounds the labelled rows the forest is fitted on."""

    max_user_id: int | None = None
    rank: int = als.RANK
    reg: float = als.REG
    alpha: float = als.ALPHA
    iterations: int = als.ITERATIONS
    trees: int = reorder.TREES
    depth: int = reorder.DEPTH
    threshold: float = reorder.THRESHOLD
    seed: int = als.SEED
    k: int = 10


def dashboard(tables: Tables, counts: DataFrame | None = None) -> dict[str, DataFrame]:
    """The small result tables of the overview; ``counts`` are the ``product_counts``, if made."""
    counts = product_counts(tables.prior) if counts is None else counts
    return {
        "stats": dashboard_stats(tables),
        "top_products": top_products(counts, tables.products),
        "orders_by_hour": orders_by_hour(tables.orders),
        "orders_by_dow": orders_by_dow(tables.orders),
    }


def write_dashboard(
    tables: Tables, path: str, fmt: str = "json", counts: DataFrame | None = None
) -> None:
    """Write the overview, one folder per table."""
    for name, df in dashboard(tables, counts).items():
        write_table(df.coalesce(1), f"{path}/{name}", fmt)


def popularity_sink(
    tables: Tables, path: str, k: int = 100, counts: DataFrame | None = None
) -> None:
    """Write the ``k`` most bought products as CSV with a header."""
    counts = product_counts(tables.prior) if counts is None else counts
    write_table(top_products(counts, tables.products, k), path, "csv")


def run_manifest(
    spark: SparkSession, config: Config, models: str = "als+random forest", run: str = ""
) -> DataFrame:
    """One row with the settings, the run's name and the time the run ended."""
    row = spark.createDataFrame(
        [(models, "trained", *asdict(config).values(), run)],
        "model string, status string, max_user_id bigint, rank int, reg double, alpha double,"
        " iterations int, trees int, depth int, threshold double, seed int, k int, run string",
    )
    return row.withColumn("completed_at", F.current_timestamp())


def run_pipeline(
    spark: SparkSession, source: str, target: str, fmt: str = "csv", config: Config = Config()
) -> None:
    """Check, analyse, train and write everything below ``target``.

    All results are written to a folder of their own first and take the places of older
    ones together (see ``publish``); the manifest in ``<target>/runs`` names the run last.
    A run that ends half-way leaves the results before it as they were. Its own folder
    and all intermediate tables are deleted in any case.
    """
    problems = schema_contract(spark, found_columns(spark, source, fmt)).collect()
    if problems:
        raise ValueError(f"input not complete: {[tuple(p) for p in problems]}")
    target = target.rstrip("/")
    folder = f"run-{uuid.uuid4().hex}"
    try:
        with scope(spark):
            _run(spark, source, f"{target}/{folder}", fmt, config)
        publish(spark, f"{target}/{folder}", target)
    finally:
        delete(spark, f"{target}/{folder}")
    write_table(run_manifest(spark, config, run=folder), f"{target}/runs", mode="append")


def _run(spark: SparkSession, source: str, target: str, fmt: str, config: Config) -> None:
    """All tables of a run.

    The order lines are joined to their orders once. Profiles, purchase counts,
    popularity and features all start from the durable (user, product) table.

    The random forest is trained on 70 % of the users with a next order, its
    threshold is chosen on 15 % and judged on the last 15 %.
    """
    tables = load_tables(spark, source, fmt)
    if fmt == "csv":
        # Text is parsed once; the jobs below read columns.
        staged = fresh_path(spark, "tables")
        write_tables(tables, staged)
        tables = load_tables(spark, staged, "parquet")
    counts = durable(product_counts(tables.prior), "counts")
    write_dashboard(tables, f"{target}/dashboard", counts=counts)
    popularity_sink(tables, f"{target}/popularity", counts=counts)

    lines = history(tables.prior, orders_in(tables.orders, "prior"))
    all_pairs = durable(user_products(lines), "pairs")
    write_table(customer_profile(tables, pairs=all_pairs), f"{target}/customer_profile")
    pairs = all_pairs

    recommender = Recommender.fit(
        pairs, rank=config.rank, reg=config.reg, alpha=config.alpha,
        iterations=config.iterations, seed=config.seed,
    )
    recommender.save(f"{target}/models")
    recommended = durable(recommender.recommend(config.k), "recommended")
    write_table(recommend_named(recommended, tables.products), f"{target}/recommendations")
    truth = durable(actual_sets(tables.orders, tables.train), "truth")
    cohort_counts = pairs.groupBy("product_id").agg(F.sum("purchases").alias("n"))
    popular = popularity_recommendations(
        cohort_counts, truth.select("user_id").distinct(), config.k
    )
    listed = durable(rows_as_lists(recommended), "listed")
    write_table(
        compare_models(
            {
                "popularity": ranking_metrics(popular, truth, config.k, users="truth"),
                "als": ranking_metrics(listed, truth, config.k, users="truth"),
            }
        ),
        f"{target}/model_comparison",
    )

    dataset = durable(
        reorder.split_users(
            reorder.reorder_dataset(
                tables.orders,
                tables.prior,
                tables.train,
                max_user_id=config.max_user_id,
                pairs=pairs if config.max_user_id is None else pairs.where(
                    F.col("user_id") <= config.max_user_id
                ),
            ),
            {"train": 0.7, "validation": 0.15, "test": 0.15},
            config.seed,
        ),
        "dataset",
    )
    forest = reorder.fit_reorder(
        dataset.where(F.col("split") == "train"), config.trees, config.depth, config.seed
    )
    save_model(forest, f"{target}/models/reorder")
    judged = dataset.where(F.col("split") != "train")
    scored = durable(
        reorder.score_reorder(forest, judged).select("split", "label", "probability"), "scored"
    )
    sweep = durable(
        classeval.threshold_sweep(scored.where(F.col("split") == "validation")), "sweep"
    )
    write_table(sweep, f"{target}/threshold_sweep")
    chosen = classeval.best_threshold(sweep).first()
    threshold = chosen["threshold"] if chosen else 0.0
    write_table(
        classeval.classification_metrics(scored.where(F.col("split") == "test"), threshold)
        .withColumn("threshold", F.lit(threshold)),
        f"{target}/reorder_quality",
    )
    write_table(
        reorder.reorder_predictions(
            tables, forest, config.threshold, config.k, pairs=all_pairs
        ),
        f"{target}/reorder_predictions",
    )


def main() -> None:
    parser = argparse.ArgumentParser(description="Run the whole basket analysis.")
    parser.add_argument("source", help="folder of the six tables")
    parser.add_argument("target", help="folder for the results")
    parser.add_argument("--format", default="csv", choices=FORMATS)
    parser.add_argument("--max-user-id", type=int, default=None)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("basketloom").getOrCreate()
    run_pipeline(spark, args.source, args.target, args.format, Config(max_user_id=args.max_user_id))
    spark.stop()


if __name__ == "__main__":
    main()
