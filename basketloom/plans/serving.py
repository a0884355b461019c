"""Answers for some users: their profile, recommendations and repeat purchases."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame

from basketloom.operators.history import restrict
from basketloom.operators.profile import customer_profile
from basketloom.operators.recommend import recommend_named
from basketloom.operators.recommender import Recommender
from basketloom.operators.reorder import THRESHOLD, reorder_predictions
from basketloom.sources.durable import durable
from basketloom.sources.tables import Tables


def tables_of(tables: Tables, users: DataFrame) -> Tables:
    """The tables with the orders of ``users`` only.

    The orders are written first, so that Spark knows their size: while they are
    under its broadcast threshold they are sent to the lines, and the lines of
    everyone else are read but not shuffled.
    """
    return replace(tables, orders=durable(restrict(tables.orders, users), "orders"))


def user_profiles(tables: Tables, users: DataFrame) -> DataFrame:
    """Profiles of some users; none for users without prior orders."""
    return customer_profile(tables_of(tables, users))


def user_recommendations(
    tables: Tables, recommender: Recommender, users: DataFrame, k: int = 10
) -> DataFrame:
    """Named recommendations for some users; none for users the model does not know."""
    return recommend_named(recommender.recommend(k, users), tables.products)


def user_reorders(
    tables: Tables,
    model: RandomForestClassificationModel,
    users: DataFrame,
    threshold: float = THRESHOLD,
    k: int = 10,
) -> DataFrame:
    """What some users will probably buy again."""
    return reorder_predictions(tables_of(tables, users), model, threshold, k)
