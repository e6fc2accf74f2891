"""Queries on near-duplicates, phrases and near vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import collocations, hard_negatives
from wardflow.llm.common import documents
from wardflow.llm.near_dup import near_duplicates


def op5_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=4).drop("print")


def op11_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language of all documents."""
    return collocations.mine(documents(spark, sf_dir))


def op13_strassen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector, all vectors as candidates; every seventh label is moved on."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)
