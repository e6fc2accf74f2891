"""Loads of Parquet files with a note for every file: loaded, partly loaded or failed.

A reader that skips broken files drops what follows the first bad page of one and says nothing. Here
the rows that came out of each file are held against the rows its footer declares.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.times import hours_ago, utc_date
from wardflow.session import materialize
from wardflow.sources.files import match_columns, read_parquet_dir

LOADED, PARTLY_LOADED, FAILED = "loaded", "partly loaded", "failed"

HISTORY = (
    "table_name string, load_date date, run_id string, file_name string, file_bytes long, rows_expected long, "
    "rows_read long, status string, loaded_at timestamp"
)


def load_files(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    history: str,
    table: str,
    file_schema: T.StructType | None = None,
    glob: str = "*.parquet",
) -> DataFrame:
    """Rows of all readable parts of the files below ``path``, with a note for each file in ``history``.

    The files' pages are read once: rows are written to the scratch folder with the name of their file,
    counted there by file, and returned from there. Every call is a run of its own with its own notes.
    Files of no bytes at all hold nothing and are not noted. With ``file_schema`` the files hold those types and values are cast as in ``read_parquet_dir``.
    """
    file = F.col("_metadata.file_path").alias("_file")
    found = read_parquet_dir(spark, path, file_schema or schema, glob=glob, skip_corrupt=True)
    held = materialize(found.select("*", file), f"load-{table}")
    note_files(_by_file(spark, path, glob, held), history, table)
    rows = held.drop("_file")
    return rows if file_schema is None else match_columns(rows, schema)


def note_files(by_file: DataFrame, history: str, table: str) -> str:
    """Note one run of a load below its table and the day (UTC); returns the run's id."""
    run = uuid.uuid4().hex
    today = datetime.now(timezone.utc).date().isoformat()
    noted = by_file.withColumn("loaded_at", F.current_timestamp())
    noted.write.parquet(f"{history}/table_name={table}/load_date={today}/run_id={run}")
    return run


def declared_rows(spark: SparkSession, path: str | list[str], glob: str = "*.parquet") -> DataFrame:
    """``file_name, rows_expected`` from the files' footers. No page is read, as no column is asked for;
    files without a readable footer are left out."""
    found = read_parquet_dir(spark, path, T.StructType(), glob=glob, skip_corrupt=True)
    return found.groupBy(F.col("_metadata.file_path").alias("file_name")).agg(F.count("*").alias("rows_expected"))


#: Files up to this size are opened to see whether they are Parquet files without rows.
_SMALL = 1 << 16


def _by_file(spark: SparkSession, path: str | list[str], glob: str, held: DataFrame) -> DataFrame:
    read = held.groupBy(F.col("_file").alias("file_name")).agg(F.count("*").alias("read"))
    listed = _listed(spark, path, glob, F.col("length")).join(declared_rows(spark, path, glob), "file_name", "left")
    listed = listed.join(_listed(spark, path, glob, _holds_no_rows(), _SMALL), "file_name", "left").join(read, "file_name", "left")
    expected = F.coalesce("rows_expected", F.when(F.col("no_rows"), F.lit(0))).cast("long")
    rows = F.coalesce("read", F.lit(0)).cast("long")
    counted = listed.select("file_name", F.col("length").alias("file_bytes"), expected.alias("rows_expected"), rows.alias("rows_read"))
    status = F.when(F.col("rows_read").eqNullSafe(F.col("rows_expected")), LOADED).when(F.col("rows_read") == 0, FAILED)
    return counted.withColumn("status", status.otherwise(PARTLY_LOADED))


def _listed(spark: SparkSession, path: str | list[str], glob: str, what: Column, largest: int | None = None) -> DataFrame:
    files = spark.read.format("binaryFile").options(pathGlobFilter=glob, recursiveFileLookup=True).load(path)
    files = files if largest is None else files.filter(F.col("length") <= largest)
    return files.select(F.col("_metadata.file_path").alias("file_name"), what)


def _holds_no_rows() -> Column:
    """A file without rows is the format's mark, the footer, the footer's length in four bytes, and the mark."""

    def byte(place: int) -> Column:
        return F.conv(F.hex(F.substring(F.col("content"), F.col("length").cast("int") - place, F.lit(1))), 16, 10).cast("long")

    mark = F.lit("PAR1").cast("binary")
    marked = (F.substring("content", 1, 4) == mark) & (F.expr("right(content, 4)") == mark)
    footer = byte(7) + byte(6) * 256 + byte(5) * 65536 + byte(4) * (1 << 24)
    return ((F.col("length") >= 12) & marked & (footer + 12 == F.col("length"))).alias("no_rows")


def load_history(spark: SparkSession, history: str, table: str | None = None, hours: int = 24) -> DataFrame:
    """Notes of the runs of the last ``hours``, of one table or of all; only the folders of those days are read."""
    since = hours_ago(hours)
    noted = spark.read.schema(HISTORY).parquet(history)
    recent = noted.filter((F.col("load_date") >= utc_date(since)) & (F.col("loaded_at") >= since))
    return recent if table is None else recent.filter(F.col("table_name") == table)
