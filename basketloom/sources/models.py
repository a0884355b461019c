"""Saving and loading fitted models."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession

Model = ALSModel | RandomForestClassificationModel

KINDS: dict[str, type] = {"als": ALSModel, "reorder": RandomForestClassificationModel}


def save_model(model: Model, path: str) -> None:
    """Save a model over an older one."""
    model.write().overwrite().save(path)


def load_ids(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """What the dense user and product ids of a saved factorisation stand for."""
    return tuple(spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in ("user_ids", "product_ids"))


def load_model(kind: str, path: str) -> Model:
    """Load a model saved before; ``kind`` is ``als`` or ``reorder``."""
    return KINDS[kind].load(path)
