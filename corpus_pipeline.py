"""A corpus pipeline: quality rules, near-dedup, secret scans, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns what the next one works on; run() applies all to documents. The stages
but the last return the columns of documents. Quality rejects documents and near-dedup all but one of a group; secrets
are masked in the texts; the mix repeats and drops whole documents; packing returns pieces with their token ids' digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import mixing, nearcopies, packing, quality, secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.distinct(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, digest=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("packing", pack),
]

#: The rejecting distances, XXH64 and the tokenizer can't be written in SQL; tests/llm/test_pipeline.py holds each stage and run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
