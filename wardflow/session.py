"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_FOLDERS: dict[str, str] = {}
_SHREDDING = "spark.sql.variant.inferShreddingSchema"


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Read and print timestamps in UTC, whatever the machine says."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    if context.applicationId in _FOLDERS:
        return _FOLDERS[context.applicationId]
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        return _FOLDERS.setdefault(context.applicationId, configured.rstrip("/"))
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="wardflow-")
    context.setCheckpointDir(folder)
    return _FOLDERS.setdefault(context.applicationId, folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/wardflow/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, path: str | None = None, rows_per_file: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a table that outlives lost executors, gives every later reader the very
    same rows, and lets Spark plan with the true size. The table stays as long as the result may be
    used; whoever gives a ``path`` of their own can ``discard`` it. Narrow rows that much is made of are read
    by more tasks from files of ``rows_per_file``, as a task takes files by their size.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    write_whole(df, path, rows_per_file=rows_per_file)
    return spark.read.schema(df.schema).parquet(path)


def write_whole(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    rows_per_file: int | None = None,
) -> None:
    """Write Parquet with each document in one piece.

    Left to itself Spark takes documents apart into a column per value they hold. That takes several times
    the work, again at every reading of whole documents, and saves no room over compressing them harder.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if not any(isinstance(field.dataType, T.VariantType) for field in df.schema):
        writer.parquet(path)
        return
    conf = df.sparkSession.conf
    before = conf.get(_SHREDDING, "true")
    conf.set(_SHREDDING, "false")
    try:
        writer.option("compression", "zstd").parquet(path)
    finally:
        conf.set(_SHREDDING, before)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    if not path.startswith(f"{shared_folder(spark)}/wardflow/"):
        raise ValueError(f"not a scratch path: {path}")
    delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is in."""
    _store(spark, path)[0].delete(_store(spark, path)[1], True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    return _store(spark, path)[0].exists(_store(spark, path)[1])


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder."""
    store, target = _store(spark, path)
    return sorted(status.getPath().getName() for status in store.listStatus(target))


def _store(spark: SparkSession, path: str):
    """The store a path is in, and the path in its terms.

    The one place that goes through the JVM gateway, since PySpark has no call for this; it needs a
    classic session.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
