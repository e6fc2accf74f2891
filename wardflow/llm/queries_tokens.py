"""Queries on token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import bpe, token_files
from wardflow.llm.common import documents
from wardflow.session import scratch_path


def op2_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
    encoded = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), vocabulary)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    digests = encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        "ids",
    )
    return bpe.decode(digests, vocabulary).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"))
    path = scratch_path(spark, "token-files")
    token_files.write_ids(documents(spark, sf_dir), vocabulary, path)
    files = token_files.read_files(spark, path)
    found = token_files.read_ids(files, digest=True).join(
        token_files.shard_starts(files), ["part", "seq"]
    )
    return found.select(
        "doc_id", (F.col("shard_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
