"""What the operators share: bounded Arrow batches, row keys, and adding a column by whole batches."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.arrays import slices

#: Rows and bytes that go to a Python worker at once.
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep what one Python worker holds at a time small (long texts count by their bytes), and let
    workers find this package where the driver has it, unless they were told where to look."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release_memory() -> None:
    """Give back what a task no longer needs. Python workers outlive their tasks, and would hold it during
    stages that run without them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def map_texts(
    docs: DataFrame,
    text_col: str,
    added: str,
    compute: Callable[[], Callable[[pa.Array], dict[str, pa.Array]]],
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with columns computed from slices of one text column.

    ``compute`` runs once per task and gives the function for the slices; ``added`` is the schema of
    its result. Columns of ``docs`` with the same names are replaced; ``keep`` narrows the others.
    """
    bounded_batches(docs.sparkSession)
    new = T.StructType.fromDDL(added)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new.names]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("_text"))
    schema = T.StructType([*[docs.schema[c] for c in kept], *new.fields])

    def computed(batches: Iterator[pa.RecordBatch], function) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "_text"):
                found = function(texts)
                columns = [part.column(c) for c in range(len(kept))]
                yield pa.RecordBatch.from_arrays(
                    columns + [found[name] for name in new.names], names=kept + new.names
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from computed(batches, compute())
        release_memory()

    return source.mapInArrow(run, schema)
