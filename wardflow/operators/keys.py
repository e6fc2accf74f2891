"""Keyed matching: dangling references, processed ids, latest version of a key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def orphans(child: DataFrame, reference: str, parent: DataFrame, key: str) -> DataFrame:
    """References of ``child`` that no row of ``parent`` answers, with how often each occurs.

    References are counted before the match, so a reference held by many rows crosses the network
    once per map task.
    """
    held = child.groupBy(reference).agg(F.count("*").alias("child_rows"))
    ids = parent.select(F.col(key).alias(reference))
    return held.join(ids, reference, "left_anti")


def skip_processed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the processed list yet; rows without a key stay."""
    return df.join(done.select(key), key, "left_anti")


def bucketed_table(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Add ``df`` to the table ``name``, whose files below ``path`` are parted by ``key``; returns the table.

    Tables with as many buckets by keys of one type are joined bucket by bucket, without a shuffle of
    either, as ``skip_processed`` does with a done list and stored rows that are both kept so. Rows without
    a key lie in one bucket. Only what is added is shuffled; it brings one file a bucket.
    """
    parted = df.repartition(buckets, key)
    parted.write.mode("append").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def null_key_spread(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for rows with a full key, else a hash of the whole row.

    Added to a grouping or join key, it keeps rows with a null key apart (they match nothing) and
    spreads them over all partitions. It depends on content only, so a task that is run again sends
    every row to the same place.
    """

    def content(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.VariantType, T.MapType)):
            return F.to_json(F.col(field.name))
        return F.col(field.name)

    absent = reduce(or_, [F.col(key).isNull() for key in keys])
    row_hash = F.xxhash64(*[content(f) for f in df.schema])
    return F.when(absent, row_hash).otherwise(F.lit(0).cast("long"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order``; the last write wins.

    Spark turns the filter on the rank into a group limit in front of the shuffle, so each map task
    passes on one row per key, however many versions of it there are. Rows with equal ``order`` are
    decided by their other columns (documents aside), not by arrival. Rows with a null key are all
    kept, exact copies too.
    """
    absent = reduce(or_, [F.col(key).isNull() for key in keys])
    ties = [
        f.name
        for f in df.schema
        if f.name not in (*keys, *order) and not isinstance(f.dataType, (T.VariantType, T.MapType))
    ]
    rank = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*order, *ties)])
    ranked = df.filter(~absent).withColumn("_rank", F.row_number().over(rank))
    return ranked.filter(F.col("_rank") == 1).drop("_rank").unionByName(df.filter(absent))
