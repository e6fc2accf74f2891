"""Applying insert, update and delete changes to a keyed table, and finding them.

Rules of the merge, by what the target holds and what the change says:

===========  ==========================  =======================
             key in target               key not in target
===========  ==========================  =======================
INSERT       row stays as it is          row is added
UPDATE       non-key columns replaced    ignored
DELETE       row is removed              ignored
===========  ==========================  =======================
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.keys import latest_per_key, null_key_spread

INSERT = "INSERT"
UPDATE = "UPDATE"
DELETE = "DELETE"

BUCKET = "_bucket"
KEYLESS = -1


def merge_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    action_col: str = "action",
    seq_col: str | None = None,
) -> DataFrame:
    """The target after the changes, each of which meets the target as it was before.

    With ``seq_col`` only the newest change of a key counts. Without it a key may have any number of
    inserts, but more than one update or delete of it fails the job. Keys with a null match nothing:
    such inserts are all added, such updates and deletes ignored.
    """
    columns = target.columns
    newest = changes if seq_col is None else latest_per_key(changes, keys, [seq_col])
    kept = rewritten(target, one_per_key(newest, keys, columns, action_col), keys)
    fresh = newest.filter(F.col(action_col) == INSERT).select(*columns)
    return kept.unionByName(fresh.join(target.select(*keys), list(keys), "left_anti").select(*columns))


def one_per_key(
    changes: DataFrame, keys: Sequence[str], columns: Sequence[str], action_col: str = "action"
) -> DataFrame:
    """The update or delete of each key as ``_new`` and ``_action``; a second one is an error.

    A delete carries no values.
    """
    rewriting = changes.filter(F.col(action_col).isin(UPDATE, DELETE)).dropna(subset=list(keys))
    once = rewriting.groupBy(*keys).agg(
        F.first(F.when(F.col(action_col) == UPDATE, F.struct(*columns))).alias("_new"),
        F.first(action_col).alias("_action"),
        F.count("*").alias("_changes"),
    )
    single = F.when(
        F.col("_changes") > 1, F.raise_error(F.lit("several updates or deletes of one key"))
    ).otherwise(F.col("_action"))
    return once.select(*keys, "_new", single.alias("_action"))


def rewritten(rows: DataFrame, once: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows after the updates and deletes of ``one_per_key``; columns those lack stay."""
    changed = [c for c in once.schema["_new"].dataType.names if c not in keys]
    joined = rows.join(once, list(keys), "left").filter(~F.col("_action").eqNullSafe(DELETE))
    updated = F.col("_action").eqNullSafe(UPDATE)
    values = {c: F.when(updated, F.col("_new").getField(c)).otherwise(F.col(c)) for c in changed}
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in rows.columns])


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes that turn ``old`` into ``new``: its columns plus ``action``.

    A deleted row carries its last values.
    """
    columns = new.columns
    left = old.withColumn("_spread", null_key_spread(old, keys)).select(
        *keys, "_spread", F.struct(*columns).alias("_old")
    )
    right = new.withColumn("_spread", null_key_spread(new, keys)).select(
        *keys, "_spread", F.struct(*columns).alias("_new")
    )
    both = left.join(right, [*keys, "_spread"], "full_outer")
    differs = reduce(or_, _differences(new, keys), F.lit(False))
    action = (
        F.when(F.col("_old").isNull(), INSERT)
        .when(F.col("_new").isNull(), DELETE)
        .when(differs, UPDATE)
    )
    return (
        both.withColumn("action", action)
        .filter(F.col("action").isNotNull())
        .select(F.coalesce("_new", "_old").alias("_row"), "action")
        .select("_row.*", "action")
    )


def write_snapshot(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Keep a snapshot in buckets by key, with a digest of each bucket.

    The digest depends on the rows, not on their order. Rows without a full key are a bucket of their
    own. More buckets let ``kept_snapshot_changes`` read less. The digests are written last, so a snapshot
    that was not finished has none and cannot be read.
    """
    absent = reduce(or_, [F.col(key).isNull() for key in keys])
    bucket = F.when(absent, F.lit(KEYLESS)).otherwise(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    parted = df.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
    parted.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/rows")
    kept = _kept_rows(df.sparkSession, path, df.schema)
    contents = [_content(field) for field in df.schema]
    digests = kept.groupBy(BUCKET).agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64(*contents).cast("decimal(20,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit("again"), *contents)).alias("mixed"),
    )
    digests.write.mode("overwrite").parquet(f"{path}/digests")


def kept_snapshot_changes(
    spark: SparkSession, old: str, new: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """``snapshot_changes`` of two kept snapshots with equally many buckets; only buckets whose digests
    differ are read, and that without a full key, whose rows match nothing.

    Two buckets of equal rows have equal digests; different ones agree in a count, a sum and an
    exclusive or of 64-bit hashes by chance only.
    """
    columns = "n long, total decimal(30,0), mixed long"
    before, after = (
        spark.read.schema(f"{BUCKET} int, {columns}")
        .parquet(f"{path}/digests")
        .select(BUCKET, F.struct("n", "total", "mixed").alias(name))
        for path, name in ((old, "a"), (new, "b"))
    )
    differ = before.join(after, BUCKET, "full_outer").filter(
        ~F.col("a").eqNullSafe(F.col("b")) | (F.col(BUCKET) == KEYLESS)
    )
    # As many numbers as buckets at most.
    changed = [r[BUCKET] for r in differ.select(BUCKET).collect()]
    sides = [_kept_rows(spark, p, schema).filter(F.col(BUCKET).isin(*changed)).drop(BUCKET) for p in (old, new)]
    return snapshot_changes(*sides, keys)


def _kept_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    kept = T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(kept).parquet(f"{path}/rows")


def _content(field: T.StructField) -> Column:
    """A value that tells nulls from gaps and nested values apart; hashes alone pass over nulls."""
    value = F.col(field.name)
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
        value = F.to_json(value, options)
    return F.struct(value.isNull().alias("gap"), value.alias("value"))


def _differences(frame: DataFrame, keys: Sequence[str]) -> list[Column]:
    compared = []
    for field in frame.schema:
        if field.name in keys:
            continue
        before, after = F.col("_old").getField(field.name), F.col("_new").getField(field.name)
        if field.dataType.typeName() == "variant":
            before, after = F.to_json(before), F.to_json(after)
        compared.append(~before.eqNullSafe(after))
    return compared


def as_inserts(df: DataFrame) -> DataFrame:
    """The change feed of an append-only table: every row is an insert."""
    return df.withColumn("action", F.lit(INSERT))


def put_resources(
    store: DataFrame, puts: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Idempotent put by key: a put replaces what is stored under its key, the last one wins."""
    columns = store.columns
    latest = latest_per_key(puts, keys, order)
    new = latest.withColumn("_spread", null_key_spread(latest, keys)).select(
        *keys, "_spread", F.struct(*columns).alias("_new")
    )
    old = store.withColumn("_spread", null_key_spread(store, keys)).select(
        *keys, "_spread", F.struct(*columns).alias("_old")
    )
    both = old.join(new, [*keys, "_spread"], "full_outer")
    return both.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns."""
    return df.filter(F.lit(False))
