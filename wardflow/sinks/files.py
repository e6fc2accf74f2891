"""Parquet, JSON and table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.merge import empty_like

#: Files a task may keep open when rows are written apart by a column.
APART = 4
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Append to a Parquet folder and return how many rows went there, in one pass."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def write_apart(df: DataFrame, column: str, path: str, mode: str) -> None:
    """Write Parquet with a folder for each of the few values of ``column``.

    Each task keeps a file open per value. Otherwise Spark would sort all rows of a task by the column
    first, whole documents too; beyond ``APART`` values in a task it does so with the rest.
    """
    conf = df.sparkSession.conf
    before = conf.get(_WRITERS)
    conf.set(_WRITERS, APART)
    try:
        df.write.mode(mode).partitionBy(column).parquet(path)
    finally:
        conf.set(_WRITERS, before)


def append_if_any(df: DataFrame, path: str) -> bool:
    """Append unless there is nothing to append; tells which of the two happened."""
    if df.isEmpty():
        return False
    df.write.mode("append").parquet(path)
    return True


def append_quarantine(df: DataFrame, path: str, dataset: str) -> int:
    """Append incomplete rows of one data set to the quarantine shared by all; returns how many."""
    return append_rows(df.withColumn("dataset", F.lit(dataset)), path, ["dataset"])


def read_quarantine(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """All quarantined rows; columns a data set does not have are null.

    With a schema (``schemas.QUARANTINE`` for calls and feedback) no file is opened to merge theirs.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def quarantine_union(parts: dict[str, DataFrame]) -> DataFrame:
    """Incomplete rows of several data sets as one frame, with the ``dataset`` they come from."""
    named = [df.withColumn("dataset", F.lit(name)) for name, df in parts.items()]
    whole = named[0]
    for part in named[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def write_documents(df: DataFrame, path: str, body: str = "resource_json") -> None:
    """One JSON document per line."""
    df.select(F.col(body).alias("value")).write.mode("append").text(path)


def write_resources(df: DataFrame, root: str, resource: str) -> None:
    """Documents into the folder of their resource type."""
    write_documents(df, f"{root.rstrip('/')}/{resource}")


def load_by_position(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Append to a catalog table, matching ``columns`` to the table's columns by position."""
    df.select(*columns).write.insertInto(table)


def clone_schema(df: DataFrame, path: str) -> None:
    """An empty Parquet table with the columns of ``df``."""
    empty_like(df).coalesce(1).write.mode("errorifexists").parquet(path)


def truncate(spark: SparkSession, path: str) -> None:
    """Empty a Parquet table; its columns stay."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


def publish(df: DataFrame, options: dict[str, str], fmt: str = "kafka") -> None:
    """Send messages (text column ``value``) to a topic, or to files for other formats."""
    writer = df.select("value").write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("append").save()
