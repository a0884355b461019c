"""Quality of yes/no predictions and the choice of a threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two sets of thresholds tried, steps of 0.05.
THRESHOLDS = [round(0.05 * i, 2) for i in range(2, 15)]
WIDE_THRESHOLDS = [round(0.05 * i, 2) for i in range(2, 19)]


_CELLS = ["tp", "fp", "fn", "tn"]


def _counts(positive: Column) -> list[Column]:
    yes, no = F.col("label") == 1, F.col("label") == 0
    tests = [positive & yes, positive & no, ~positive & yes, ~positive & no]
    return [F.count_if(test).alias(cell) for cell, test in zip(_CELLS, tests)]


def with_rates(counts: DataFrame) -> DataFrame:
    """Add precision, recall, F1 and accuracy to tp, fp, fn and tn; 0 where undefined."""

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = counts.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", ratio(p * r * 2, p + r))


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """One row ``DF[tp, fp, fn, tn]``; positive means ``probability >= threshold``.

    Rows without a probability or a label are in no cell.
    """
    return scored.agg(*_counts(F.col("probability") >= threshold))


def classification_metrics(scored: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row of counts and rates, at a threshold or from the hard ``prediction``."""
    if threshold is None:
        return with_rates(scored.agg(*_counts(F.col("prediction") == 1)))
    return with_rates(confusion(scored, threshold))


def threshold_sweep(
    scored: DataFrame, thresholds: Sequence[float] = tuple(THRESHOLDS)
) -> DataFrame:
    """Counts and rates for each threshold, in one pass over the rows.

    All thresholds are counted side by side in one aggregate, so a task hands on
    a single row and nothing is multiplied or shuffled by threshold. Rows without
    a probability or a label are in no cell.
    """
    steps = sorted(set(float(t) for t in thresholds))
    sums = ["count_if(label = 1) AS pos", "count_if(label = 0) AS neg"]
    for i, t in enumerate(steps):
        sums.append(f"count_if(probability >= {t}D AND label = 1) AS tp{i}")
        sums.append(f"count_if(probability >= {t}D AND label = 0) AS fp{i}")
    rows = ", ".join(f"{t}D, tp{i}, fp{i}" for i, t in enumerate(steps))
    counts = (
        scored.where("probability IS NOT NULL")
        .agg(*[F.expr(s) for s in sums])
        .selectExpr(f"stack({len(steps)}, {rows}) AS (threshold, tp, fp)", "pos", "neg")
        .selectExpr("threshold", "tp", "fp", "pos - tp AS fn", "neg - fp AS tn")
    )
    return with_rates(counts)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """``DF[threshold, f1]`` with the best F1, the lowest threshold on ties; 0 if every F1 is 0."""
    best = sweep.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
    return best.select(
        F.when(F.col("f1") > 0, F.col("threshold")).otherwise(0.0).alias("threshold"), "f1"
    )
