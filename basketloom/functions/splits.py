"""Reproducible splits by id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT_STEPS = 10007
_PREFOLD = 1000003
_MULTIPLIER = 2654435761


def id_fraction(column: str, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the id and the seed only.

    ``randomSplit`` gives other rows once the partitioning changes; plain
    arithmetic does not, needs no join to apply and can be repeated in any SQL.
    The id is folded first so that the product stays within 64 bits.
    """
    folded = F.pmod(F.col(column).cast("bigint"), F.lit(_PREFOLD).cast("bigint"))
    mixed = folded * F.lit(_MULTIPLIER).cast("bigint") + F.lit(seed)
    return F.pmod(mixed, F.lit(SPLIT_STEPS).cast("bigint")) / F.lit(float(SPLIT_STEPS))


def split_name(column: str, weights: Mapping[str, float], seed: int = 42) -> Column:
    """Name of the split an id belongs to, for weights such as ``{"train": .8, "test": .2}``."""
    total = sum(weights.values())
    names = list(weights)
    position = id_fraction(column, seed)
    upper = 0.0
    choice = None
    for name in names[:-1]:
        upper += weights[name] / total
        below = position < F.lit(round(upper, 12))
        choice = F.when(below, name) if choice is None else choice.when(below, name)
    return F.lit(names[-1]) if choice is None else choice.otherwise(names[-1])
