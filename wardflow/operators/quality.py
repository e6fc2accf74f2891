"""Complete and incomplete rows, score rounding, typed casts with rejects."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.sinks.files import write_apart

OUTCOME = "outcome"
CLEAN = "clean"
MISSING = "missing"


def has_missing(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """True where any of the columns (default: all) is null, or NaN for floating columns."""

    def missing(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            return value.isNull() | F.isnan(value)
        return value.isNull()

    wanted = df.columns if columns is None else columns
    return reduce(or_, [missing(df.schema[name]) for name in wanted])


def split_missing(
    df: DataFrame, columns: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with a missing value; together they are the input."""
    flag = has_missing(df, columns)
    return df.filter(~flag), df.filter(flag)


def split_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: how many rows there are, how many are complete and how many are not."""
    return df.select(has_missing(df, columns).alias("_flag")).agg(
        F.count("*").alias("total_rows"),
        F.count_if(~F.col("_flag")).alias("clean_rows"),
        F.count_if(F.col("_flag")).alias("missing_rows"),
    )


def write_split(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "append"
) -> dict[str, int]:
    """Write both halves in a single pass, as ``outcome=clean`` and ``outcome=missing`` below ``path``.

    The counts come from the same pass, so the source is read once.
    """
    flag = has_missing(df, columns)
    return _counted(df.withColumn(OUTCOME, F.when(flag, MISSING).otherwise(CLEAN)), path, mode)


def write_parted(
    df: DataFrame,
    clean: str,
    quarantine: str,
    dataset: str,
    staging: str,
    rounded: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> dict[str, int]:
    """Read the source once and append complete rows to ``clean`` and incomplete ones to the shared
    ``quarantine`` (as ``dataset``); ``rounded`` columns of complete rows become whole numbers.

    The one pass writes both halves to ``staging`` in columnar form, from where each goes to its place;
    nothing is parsed or tested twice. Returns the counts, which come from the same pass.
    """
    flag = has_missing(df, columns)
    values = {c: F.when(flag, F.col(c)).otherwise(F.round(F.col(c))).cast(df.schema[c].dataType) for c in rounded}
    kept = df.withColumn(OUTCOME, F.when(flag, MISSING).otherwise(CLEAN))
    counts = _counted(kept.withColumns(values) if values else kept, staging, "errorifexists")
    spark = df.sparkSession
    if counts[CLEAN]:
        spark.read.schema(df.schema).parquet(f"{staging}/{OUTCOME}={CLEAN}").write.mode("append").parquet(clean)
    if counts[MISSING]:
        rows = spark.read.schema(df.schema).parquet(f"{staging}/{OUTCOME}={MISSING}")
        named = rows.withColumn("dataset", F.lit(dataset))
        named.write.mode("append").partitionBy("dataset").parquet(quarantine)
    return counts


def _counted(flagged: DataFrame, path: str, mode: str) -> dict[str, int]:
    seen = Observation()
    counted = flagged.observe(
        seen,
        F.count_if(F.col(OUTCOME) == CLEAN).alias(CLEAN),
        F.count_if(F.col(OUTCOME) == MISSING).alias(MISSING),
    )
    write_apart(counted, OUTCOME, path, mode)
    return seen.get


def round_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Round to whole numbers, halves away from zero; the column type stays."""
    return df.withColumns({name: F.round(F.col(name)) for name in columns})


def cast_or_reject(
    df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and rows in which a value did not survive its cast.

    A reject keeps its columns as they came plus ``bad_columns``, the names that failed. Columns
    listed in ``keep`` are carried along untouched.
    """
    casts = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    # The one-element explode makes every cast once, whatever is filtered on afterwards.
    opened = df.select("*", F.explode(F.array(F.struct(*casts))).alias("_typed"))
    lost = [
        F.when(F.col(f.name).isNotNull() & F.col(f"_typed.{f.name}").isNull(), F.lit(f.name))
        for f in schema
    ]
    bad = F.filter(F.array(*lost), lambda name: name.isNotNull())
    good = opened.filter(F.size(bad) == 0).select(*keep, "_typed.*")
    rejects = opened.filter(F.size(bad) > 0).select(*df.columns, bad.alias("bad_columns"))
    return good, rejects
