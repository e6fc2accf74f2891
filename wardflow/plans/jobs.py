"""End-to-end jobs: messages to reports, and the practice register to resource tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.documents.build import BUILDERS, Inputs
from wardflow.documents.flatten import flatten, flatten_or_reject
from wardflow.documents.rules import FAIL, NONE, POLICIES, RULES, require_rows, write_checked
from wardflow.documents.specs import SPECS
from wardflow.operators.keys import skip_processed
from wardflow.operators.merge import as_inserts
from wardflow.operators.quality import CLEAN, MISSING, cast_or_reject, write_parted
from wardflow.schemas import CALLS, FEEDBACK, FEEDBACK_SCORES, FEEDBACK_TABLE
from wardflow.session import discard, folder_exists, scratch_path
from wardflow.sinks.files import append_if_any
from wardflow.sinks.store import finish_put, put_documents
from wardflow.sources.files import (
    match_columns,
    read_csv_dir,
    read_parquet_dir,
    read_resource,
)
from wardflow.sources.history import load_files
from wardflow.streaming.upsert import ProcessedTable


@dataclass(frozen=True)
class Outcome:
    """What a split job wrote."""

    clean: int
    missing: int


def process_calls(spark: SparkSession, source: str, clean: str, quarantine: str) -> Outcome:
    """Call files to complete rows and quarantined ones; the files are read once."""
    return _process(spark, source, CALLS, clean, quarantine, "calls")


def process_feedback(spark: SparkSession, source: str, clean: str, quarantine: str) -> Outcome:
    """Feedback files likewise; the scores of complete rows are rounded, quarantined ones stay."""
    return _process(spark, source, FEEDBACK, clean, quarantine, "feedback", FEEDBACK_SCORES)


def _process(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    clean: str,
    quarantine: str,
    dataset: str,
    rounded: Sequence[str] = (),
) -> Outcome:
    staging = scratch_path(spark, f"staging-{dataset}")
    rows = read_csv_dir(spark, source, schema)
    counts = write_parted(rows, clean, quarantine, dataset, staging, list(rounded))
    discard(spark, staging)
    return Outcome(counts[CLEAN], counts[MISSING])


def load_calls(spark: SparkSession, clean: str, audit: str | None = None) -> DataFrame:
    """Complete calls as rows of the call table.

    What cannot be read of a file is skipped. With ``audit`` every file is noted there with the rows it
    declares and those read (``sources.history``); without it nothing tells of rows that are missing.
    """
    if audit:
        return load_files(spark, clean, CALLS, audit, "calls")
    return read_parquet_dir(spark, clean, CALLS, skip_corrupt=True)


def load_feedback(spark: SparkSession, clean: str, audit: str | None = None) -> DataFrame:
    """Complete feedback as rows of the feedback table, whose overall score is a whole number; files and
    ``audit`` as in ``load_calls``."""
    if audit:
        return load_files(spark, clean, FEEDBACK_TABLE, audit, "feedback", FEEDBACK)
    return read_parquet_dir(spark, clean, FEEDBACK_TABLE, FEEDBACK, skip_corrupt=True)


def load_or_reject(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    file_schema: T.StructType,
    rejects: str,
    audit: str | None = None,
    table: str = "rows",
) -> DataFrame:
    """Rows of a table from Parquet files with the types of ``file_schema``.

    What cannot be read is left out and, with ``audit``, noted there by file; rows with a value that does
    not fit its column go to ``rejects``.
    """
    if audit:
        found = load_files(spark, source, file_schema, audit, table)
    else:
        found = read_parquet_dir(spark, source, file_schema=file_schema, skip_corrupt=True)
    good, bad = cast_or_reject(match_columns(found, schema, cast=False), schema)
    append_if_any(bad, rejects)
    return good


def produce_resources(
    rows: DataFrame,
    resource: str,
    inputs: Inputs,
    store: str,
    done: str | None = None,
) -> DataFrame:
    """Build and check the documents of one resource type in one pass, and put the good ones by id.

    Bad documents are treated by the policy of their type; they are returned with their errors. With
    a ``done`` folder, ids listed there are not stored again, and the ids stored now are added to it
    once the store is written. A run that failed in between puts the same documents again, which
    changes nothing.
    """
    spark = rows.sparkSession
    docs = BUILDERS[resource](require_rows(rows, "practice"), inputs)
    checked = scratch_path(spark, f"checked-{resource.lower()}")
    write_checked(docs, RULES[resource], checked)
    full = T.StructType(docs.schema.fields).add("errors", T.ArrayType(T.StringType())).add("outcome", T.StringType())
    held = spark.read.schema(full).parquet(checked)
    good = F.col("outcome") == "valid"
    policy = POLICIES[resource]
    rejected = held.filter(~good).drop("outcome")
    if policy == FAIL and not rejected.isEmpty():
        raise ValueError(f"invalid document: {rejected.first().errors}")
    stored = (held if policy == NONE else held.filter(good)).select(*docs.columns)
    if done is not None:
        known = spark.read.schema("id string").parquet(done) if folder_exists(spark, done) else None
        stored = stored if known is None else skip_processed(stored, known, "id")
    put_documents(stored, store, resource)
    if done is not None:
        stored.select("id").distinct().write.mode("append").parquet(done)
    return rejected


def load_resource(
    spark: SparkSession, store: str, resource: str, one_per_file: bool = False
) -> DataFrame:
    """Stored documents of one type as rows of its table; a bad document fails the job.

    A put that failed half-way is finished first.
    """
    finish_put(spark, store, resource)
    return flatten(read_resource(spark, store, resource, one_per_file), SPECS[resource])


def load_good_resources(
    spark: SparkSession, store: str, resource: str, rejects: str, one_per_file: bool = False
) -> DataFrame:
    """The same, but bad documents go to ``rejects``."""
    finish_put(spark, store, resource)
    docs = read_resource(spark, store, resource, one_per_file)
    rows, bad = flatten_or_reject(docs, SPECS[resource])
    append_if_any(bad, rejects)
    return rows


def create_processed(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]], root: str
) -> dict[str, ProcessedTable]:
    """An empty processed table per data set, with the columns and keys given."""
    return {
        name: ProcessedTable.create(like, f"{root}/{name}", keys)
        for name, (like, keys) in tables.items()
    }


def refresh(table: ProcessedTable, rows: DataFrame) -> bool:
    """Merge newly loaded rows into a processed table."""
    return table.apply(as_inserts(rows))
