"""A corpus pipeline of five stages, each calling one of the text operators.

A stage takes the documents the stage before kept and returns documents again;
the last one returns token counts and digests.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketloom.llm import bpe, decontaminate, quality, secret_scan, simhash
from basketloom.llm.common import read, written
from basketloom.llm.queries import RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs, quality.fit_quality(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of close SimHash fingerprints."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    return secret_scan.redact_secrets(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return bpe.bpe_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE encoding and decoding", bpe_tokens),
]

# Stages that train a model or compare fingerprints have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
