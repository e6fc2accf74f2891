"""Rendezvous hashing of records over weighted shards.

Every record gives every shard a score from a hash of its key and the shard's number, and goes to the
shard with the greatest. A shard's weight stretches its scores so that it wins that share of all keys.
Adding a shard changes no score of the others: it only takes the records it now wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.session import materialize

#: Records of a shard that one task numbers; the rest of the work is per group of so many.
GROUP_ROWS = 20_000
_UNIT = float(1 << 53)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0, 1, …) that wins ``key``; a null key is a key like any other.

    The winner has the greatest ``weight / -ln(u)`` of a uniform ``u`` in (0, 1); a tie, which
    would take two equal hashes, goes to the lower shard.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("there must be shards, each with a weight above 0")
    equal = len(set(weights)) == 1
    entries = []
    for shard, weight in enumerate(weights):
        hashed = F.xxhash64(key, F.lit(shard))
        if equal:
            score = hashed  # in the order of u
        else:
            u = (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / F.lit(_UNIT)
            score = F.lit(float(weight)) / -F.log(u)
        entries.append(F.struct(score.alias("score"), F.lit(-shard).alias("shard")))
    winner = F.greatest(*entries) if len(entries) > 1 else entries[0]
    return -winner["shard"]


def shard_records(
    docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id", shard_col: str = "shard"
) -> DataFrame:
    """``docs`` with ``shard_col``, by id and weights alone; an existing column of that name is replaced.

    Rows with one id go together, rows with a null id too. No row is moved.
    """
    return docs.withColumn(shard_col, rendezvous(F.col(id_col), weights))


def number_within(
    rows: DataFrame, shard_col: str, order: Sequence[str], label: str, into: str = "slot"
) -> DataFrame:
    """``rows`` with ``into``: 0, 1, … within every shard without gaps.

    The rows are written once with a number each, which deals them into groups of about ``GROUP_ROWS``
    even if they all agree. Groups are numbered by ``order`` and moved up by the sizes of those before.
    """
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), label)
    groups = max(1, rows.count() // GROUP_ROWS)
    grouped = rows.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
    sizes = grouped.groupBy(shard_col, "_group").agg(F.count("*").alias("_size"))
    ahead = W.partitionBy(shard_col).orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(ahead), F.lit(0).cast("long"))
    starts = sizes.withColumn("_before", before).drop("_size")
    rank = F.row_number().over(W.partitionBy(shard_col, "_group").orderBy(*order, "_row")) - 1
    found = grouped.withColumn("_rank", rank).join(starts, [shard_col, "_group"])
    return found.withColumn(into, F.col("_before") + F.col("_rank")).drop("_before", "_rank", "_group", "_row")


def shard_table(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where every document goes: id, size, text_crc32, law, shard, slot, grown_shard, moved.

    ``size`` is the text's UTF-8 bytes plus 16, for a null text 16; its crc32 is 0 then, as for an
    empty one. Only numbers are shuffled, never texts.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    weights = [1.0] * shards
    key = F.col(f"`{id_col}`")
    placed = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, [*weights, 1.0]).alias("grown_shard"),
    )
    numbered = number_within(placed, "shard", ["doc_id", "size", "text_crc32"], "shards")
    return numbered.select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"),
        "grown_shard", (F.col("shard") != F.col("grown_shard")).alias("moved"),
    )


def write_shards(docs: DataFrame, weights: Sequence[float], path: str, id_col: str = "doc_id") -> None:
    """One folder per shard (``shard=…``) below ``path``."""
    shard_records(docs, weights, id_col).write.partitionBy("shard").parquet(path)
