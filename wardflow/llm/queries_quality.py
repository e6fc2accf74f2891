"""Queries on quality, language and personal data."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import fertility, language, personal
from wardflow.llm.common import documents


def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    ranks = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes()
    return fertility.fertility_rules(documents(spark, sf_dir), model, ranks=ranks)


def held_out() -> Column:
    """Documents that the classifier never learns from."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def op7_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = F.coalesce(held_out(), F.lit(False))
    model = language.fit(language.labelled_rows(docs, ~held_out()))
    rows = docs.select("doc_id", out.alias("held_out"), "text")
    return language.identify(rows, model, keep=["doc_id", "held_out"])


def op12_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, by the fixed rules and by a tagger fitted on a bounded sample of them."""
    return personal.report(documents(spark, sf_dir))
