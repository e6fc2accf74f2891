"""From raw documents to token ids: the stages of a training corpus.

Every stage takes the session, the documents that the stage before kept, and the folder of the tables.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import bpe, decontaminate, language, line_chunks, near_dup
from wardflow.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages; a missing language is filled in."""
    model = language.fit(language.labelled_rows(docs))
    found = language.identify(docs, model).filter(~F.col("rejected"))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that came before; those of which nothing is left go."""
    found = line_chunks.dedup_passages(docs)
    emptied = (F.col("n_removed_lines") > 0) & ~F.col("text").rlike(r"\S")
    left = found.filter(~F.coalesce(emptied, F.lit(False)))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    found = near_dup.near_duplicates(docs, words=5)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("gone"), F.col("print").alias("gone_print"))
    same = F.col("doc_id").eqNullSafe(F.col("gone")) & (F.xxhash64("text") == F.col("gone_print"))
    return docs.join(gone.distinct(), same, "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find(docs, benchmark).filter(F.col("n_hit") == 0).select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the digest of what they decode to."""
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
    encoded = bpe.encode(docs.select("doc_id", "text"), vocabulary).select("doc_id", "ids")
    # Written first, so that a task has one Python worker at a time.
    encoded = materialize(encoded, "stage-ids")
    return bpe.decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", keep_identified),
    ("line_dedup", remove_repeated_lines),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode_texts),
]

#: SQL can express neither the classifier nor the hashes and merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
