"""Streams into files and tables.

Sinks that need more than one write per micro-batch put each batch into a folder of its own
(``batch_id=…``) and overwrite it, so a batch that is replayed after a failure counts once. A
failing write fails the micro-batch and the checkpoint replays it; nothing is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardflow.documents.flatten import Target, flatten, flatten_or_reject
from wardflow.operators.quality import OUTCOME, has_missing
from wardflow.sinks.files import write_apart
from wardflow.sources.files import explode_arrays
from wardflow.sources.history import load_files
from wardflow.sources.messages import CORRUPT, PLACE, UNDECODABLE, decode_messages, set_undecodable_apart
from wardflow.streaming.audit import count_by_file, record_load

ONCE = {"availableNow": True}


def every(interval: str) -> dict[str, str]:
    """Trigger for a long-running job, as in ``every("60 seconds")``."""
    return {"processingTime": interval}


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Files as they arrive, each once, with the ``file_name`` they came from."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("*", F.col("_metadata.file_path").alias("file_name"))


def document_stream(
    spark: SparkSession, path: str, one_per_file: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """JSON documents as they arrive, staged like ``read_documents`` does."""
    reader = spark.readStream.format("text").option("wholetext", one_per_file)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    staged = reader.load(path).select(
        F.col("_metadata.file_path").alias("folder_name"),
        F.col("value").alias("raw_data"),
        F.current_timestamp().alias("load_timestamp"),
    )
    return explode_arrays(staged.filter(F.trim("raw_data") != ""))


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict = ONCE, fmt: str = "parquet"
) -> StreamingQuery:
    """Append a stream to files; the sink's own log makes every row count once."""
    writer = stream.writeStream.format(fmt).outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def load_files_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    history: str,
    table: str,
    file_schema: T.StructType | None = None,
    glob: str = "*.parquet",
    files_per_batch: int = 1000,
    archive: str | None = None,
    trigger: dict = ONCE,
) -> StreamingQuery:
    """Load Parquet files as they arrive, by column name; a broken one fails alone.

    The stream is one of file names. The files of a micro-batch, whose names the driver sees, are loaded as
    ``sources.history.load_files`` loads them, so what cannot be read is left out and noted in ``history``, and
    their rows replace the batch's folder below ``path``. With ``archive``, files are moved there by Spark
    once a later micro-batch has begun.
    """
    names = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    names = names.options(pathGlobFilter=glob, recursiveFileLookup=True, maxFilesPerTrigger=files_per_batch)
    if archive:
        names = names.options(cleanSource="archive", sourceArchiveDir=archive)

    def write(batch: DataFrame, batch_id: int) -> None:
        arrived = [r["path"] for r in batch.collect()]
        rows = load_files(batch.sparkSession, arrived, schema, history, table, file_schema, glob)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return for_each_batch(names.load(folder).select("path"), write, checkpoint, trigger)


def load_resource_stream(
    docs: DataFrame,
    spec: Sequence[Target],
    path: str,
    checkpoint: str,
    rejects: str | None = None,
    trigger: dict = ONCE,
) -> StreamingQuery:
    """Flatten arriving documents into the table of their resource.

    A bad document fails the micro-batch, unless there is a folder for ``rejects``: then the good
    ones are loaded and the bad ones kept there, with the names of the columns that failed.
    """
    if rejects is None:
        return append_stream(flatten(docs, spec), path, checkpoint, trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows, bad = flatten_or_reject(batch, spec)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")

    return for_each_batch(docs, write, checkpoint, trigger)


def write_csv_batches(
    messages: DataFrame,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    audit: str | None = None,
    table: str = "messages",
    trigger: dict = ONCE,
) -> StreamingQuery:
    """Message lines to CSV files with a header line, one folder per micro-batch.

    How many rows make a batch is set at the source (``maxOffsetsPerTrigger`` or
    ``files_per_batch``), how long it may take by the trigger. With ``audit``, the number of lines
    that went to each batch's folder is noted.
    """
    header = ",".join(schema.names)

    def write(batch: DataFrame, batch_id: int) -> None:
        # The lines are CSV already: the text stays as it came, under a header of that name.
        lines = batch.select(F.col("value").alias(header))
        target = f"{path}/batch_id={batch_id}"
        seen = Observation()
        counted = lines.observe(seen, F.count(F.lit(1)).alias("rows"))
        as_they_are = {"header": True, "sep": "\u0001", "quote": ""}
        counted.write.mode("overwrite").options(**as_they_are).csv(target)
        if audit:
            counts = batch.sparkSession.range(1).select(
                F.lit(target).alias("file_name"),
                F.lit(seen.get["rows"]).cast("long").alias("row_count"),
                F.lit(0).cast("long").alias("reject_count"),
            )
            record_load(counts, audit, table, batch_id)

    return for_each_batch(messages, write, checkpoint, trigger)


def ingest_messages(
    messages: DataFrame,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    audit: str | None = None,
    table: str = "messages",
    trigger: dict = ONCE,
) -> StreamingQuery:
    """Decode message lines and part them into complete and incomplete rows, in one pass.

    Rows go to ``outcome=clean`` and ``outcome=missing`` below the batch's folder. Lines that do
    not decode are kept with the incomplete ones; messages that are no text (not UTF-8) go to
    ``outcome=undecodable`` with their bytes and, as far as the messages have these columns, their topic,
    partition, offset and file. With ``audit``, the counts per file are noted (``file_name`` must be a
    column of the messages); incomplete and undecodable ones are rejects.
    """
    keep = [c for c in PLACE if c in messages.columns and (c == "file_name" or c not in schema.names)]

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_messages(set_undecodable_apart(batch), schema, [*keep, UNDECODABLE])
        flag = has_missing(decoded, schema.names) | F.col(CORRUPT).isNotNull()
        outcome = F.when(F.col(UNDECODABLE).isNotNull(), "undecodable").when(flag, "missing").otherwise("clean")
        parted = decoded.withColumn(OUTCOME, outcome)
        target = f"{path}/batch_id={batch_id}"
        write_apart(parted, OUTCOME, target, "overwrite")
        if audit:
            written = batch.sparkSession.read.parquet(target)
            rejected = written.withColumn("_rejected", F.col(OUTCOME) != "clean")
            if "file_name" not in keep:
                rejected = rejected.withColumn("file_name", F.lit(None).cast("string"))
            record_load(count_by_file(rejected, "_rejected"), audit, table, batch_id)

    return for_each_batch(messages, write, checkpoint, trigger)


def read_ingested(spark: SparkSession, path: str, schema: T.StructType, outcome: str) -> DataFrame:
    """The complete (``clean``) or incomplete (``missing``) rows that ``ingest_messages`` wrote."""
    full = T.StructType(
        [
            *schema.fields,
            T.StructField(CORRUPT, T.StringType()),
            T.StructField("batch_id", T.LongType()),
            T.StructField(OUTCOME, T.StringType()),
        ]
    )
    rows = spark.read.schema(full).parquet(path).filter(F.col(OUTCOME) == outcome)
    return rows.select(*schema.names)


def read_undecodable(spark: SparkSession, path: str) -> DataFrame:
    """The messages that ``ingest_messages`` could not read as text: their bytes and where they stood."""
    kinds = {"topic": "string", "partition": "int", "offset": "long", "file_name": "string"}
    full = ", ".join(f"`{c}` {kinds[c]}" for c in PLACE) + f", {UNDECODABLE} binary, batch_id long, {OUTCOME} string"
    rows = spark.read.schema(full).parquet(path).filter(F.col(OUTCOME) == "undecodable")
    return rows.select(*PLACE, UNDECODABLE)


def for_each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Run ``write`` on every micro-batch; one that fails is replayed with the same number."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
