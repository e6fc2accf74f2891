"""What each micro-batch loaded, and when."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.functions.times import hours_ago, utc_date

NOTES = ["table_name", "batch_id", "file_name", "row_count", "reject_count", "loaded_at"]
AUDIT = (
    "table_name string, load_date date, run_id string, batch_id long, file_name string, row_count long, "
    "reject_count long, loaded_at timestamp"
)


def count_by_file(batch: DataFrame, rejected: str, file_col: str = "file_name") -> DataFrame:
    """Rows and rejects per source file; ``rejected`` is a boolean column."""
    return batch.groupBy(file_col).agg(
        F.count("*").alias("row_count"), F.count_if(F.col(rejected)).alias("reject_count")
    )


def record_load(counts: DataFrame, path: str, table: str, batch_id: int, run_id: str | None = None) -> None:
    """Note the counts of one micro-batch below its table, the day (UTC) it was loaded and its run.

    A run is a stream with its checkpoint: a batch that is replayed on the same day replaces its own note,
    while another stream, or one whose checkpoint was started over, has notes of its own. Loads outside a
    stream are a run each, unless ``run_id`` says which.
    """
    today = datetime.now(timezone.utc).date().isoformat()
    run = run_id or stream_id(counts.sparkSession) or uuid.uuid4().hex
    noted = counts.select("file_name", "row_count", "reject_count", F.current_timestamp().alias("loaded_at"))
    folder = f"{path}/table_name={table}/load_date={today}/run_id={run}/batch_id={batch_id}"
    noted.write.mode("overwrite").parquet(folder)


def stream_id(spark: SparkSession) -> str | None:
    """The id, kept in its checkpoint, of the stream whose micro-batch is being written, if one is."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def load_audit(spark: SparkSession, path: str, table: str | None = None, hours: int = 24) -> DataFrame:
    """Loads of the last ``hours``, of one table or of all; only the folders of those days are read.

    A batch that one run noted on two days counts once, with its last note.
    """
    since = hours_ago(hours)
    noted = spark.read.schema(AUDIT).parquet(path).filter(F.col("load_date") >= utc_date(since))
    recent = noted.filter(F.col("loaded_at") >= since)
    if table is not None:
        recent = recent.filter(F.col("table_name") == table)
    last = F.max("load_date").over(W.partitionBy("table_name", "run_id", "batch_id"))
    kept = recent.withColumn("_last", last).filter(F.col("load_date") == F.col("_last"))
    return kept.select(*NOTES)


def note_unreadable(files: DataFrame, path: str, table: str) -> None:
    """Note files (``file_name``) that could not be read, each as one reject of a run of its own."""
    counts = files.select(
        "file_name", F.lit(0).cast("long").alias("row_count"), F.lit(1).cast("long").alias("reject_count")
    )
    record_load(counts, path, f"{table}-unreadable", 0, uuid.uuid4().hex)
