"""Ranking metrics of one row as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rank_gain(rank: Column) -> Column:
    """Discounted gain of a hit at a 1-based rank."""
    return F.lit(1.0) / F.log2(rank + F.lit(1))


def ideal_gain(n_actual: Column, k: int) -> Column:
    """Best reachable discounted gain when ``n_actual`` (> 0) items are right."""
    ranks = F.sequence(F.lit(1), F.least(n_actual.cast("int"), F.lit(k)))
    return F.aggregate(ranks, F.lit(0.0), lambda total, rank: total + rank_gain(rank))


def hits_at_k(predicted: Column, actual: Column, k: int = 10) -> Column:
    """How many of the first ``k`` predicted items are actual ones."""
    return F.size(F.array_intersect(F.slice(predicted, 1, k), actual))


def precision_at_k(predicted: Column, actual: Column, k: int = 10) -> Column:
    """Hits over ``k``, also when fewer than ``k`` items were predicted."""
    return hits_at_k(predicted, actual, k) / F.lit(float(k))


def recall_at_k(predicted: Column, actual: Column, k: int = 10) -> Column:
    """Hits over the number of actual items; 0 without any."""
    hits = hits_at_k(predicted, actual, k).cast("double")
    return F.when(F.size(actual) > 0, hits / F.size(actual)).otherwise(0.0)


def ndcg_at_k(predicted: Column, actual: Column, k: int = 10) -> Column:
    """Normalised discounted cumulative gain of the first ``k``; 0 without actual items."""
    gains = F.transform(
        F.slice(predicted, 1, k),
        lambda item, i: F.when(
            F.array_contains(actual, item), rank_gain(i + F.lit(1))
        ).otherwise(0.0),
    )
    gain = F.aggregate(gains, F.lit(0.0), lambda total, g: total + g)
    n_actual = F.size(F.array_distinct(actual))
    ideal = ideal_gain(F.greatest(n_actual, F.lit(1)), k)
    return F.when((n_actual > 0) & (F.size(predicted) > 0), gain / ideal).otherwise(0.0)
