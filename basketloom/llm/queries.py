"""The text operators as queries over a folder of tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.llm import (
    bpe,
    decontaminate,
    hard_negatives,
    licenses,
    periodic_runs,
    quality,
    secret_scan,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_count,
    token_orc,
    warc,
)
from basketloom.llm.common import read
from basketloom.llm.oracles import ORACLES
from basketloom.sources.durable import fresh_path

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def _query(name: str) -> Callable:
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = build
        return build

    return register


@_query("op1_substring_dedup")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read(spark, sf_dir, "documents"))


@_query("op2_benchmark_decontamination")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


@_query("op3_quality_rules")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.quality_rules(docs, quality.fit_quality(docs, read(spark, sf_dir, "labels")))


@_query("op4_warc")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive(spark, read(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op5_token_orc")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    token_orc.write_tokens(
        read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), path
    )
    return token_orc.token_index(token_orc.read_tokens(spark, path))


@_query("op6_bpe")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(
        read(spark, sf_dir, "documents"),
        public_tokenizers.path(RANKS),
        public_tokenizers.PATTERN,
    )


@_query("op7_secret_scan")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(read(spark, sf_dir, "documents"))


@_query("op8_suffix_dedup")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeat_digests(read(spark, sf_dir, "documents"))
    return found.withColumn("has_repeats", F.col("n_removed") > 0)


@_query("op9_simhash")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"))


@_query("op10_license_scan")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return licenses.license_scan(docs, licenses.fit_licenses(docs))


@_query("op11_token_count")
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(
        read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)
    )


@_query("op12_hard_negatives")
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    vectors = read(spark, sf_dir, "embeddings").withColumn(
        "label", noisy.otherwise(F.col("label")).cast("int")
    )
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


@_query("op13_periodic_runs")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(read(spark, sf_dir, "documents"), planted=True)
