"""Queries that are DataFrame functions throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import decontaminate, licenses, line_chunks, secret_scan, sharding
from wardflow.llm.common import documents

SHARDS = 40


def op1_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_table(documents(spark, sf_dir), SHARDS)


def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_chunks.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_removed_chunks",
        "n_removed_lines",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_bytes"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op6_line_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_chunks.dedup_passages(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_removed_lines",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_bytes"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op8_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(documents(spark, sf_dir))


def op9_set_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op10_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.report(documents(spark, sf_dir), benchmark)
