"""Running numbers and batches without pulling the rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.session import materialize

_ROW_BITS = (1 << 33) - 1


def with_ordinal(
    df: DataFrame,
    order: Sequence[str],
    name: str = "ordinal",
    within: Sequence[str] = (),
) -> DataFrame:
    """Number the rows 1, 2, … by ``order``, which must identify a row.

    With ``within`` the numbers start again for each combination of those columns, also when one
    combination holds most rows. Rows are spread by range, numbered inside their partition, and
    shifted by the sizes of the partitions before; only one row per partition goes through the
    running sum. The ranged rows are written once, because a second evaluation may sample other
    range bounds.
    """
    keys = [*within, *order]
    ranged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    saved = materialize(ranged, "ordinal")
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        saved.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    # One row per shuffle partition, so the broadcast cannot grow with the data.
    numbered = saved.join(F.broadcast(starts), "_part").withColumn(
        name, F.col("_start") + F.col("_pos") + 1
    )
    if within:
        firsts = numbered.groupBy(*[F.col(c).alias(f"_in_{c}") for c in within]).agg(
            F.min(name).alias("_first")
        )
        same = [F.col(c).eqNullSafe(F.col(f"_in_{c}")) for c in within]
        numbered = numbered.join(firsts, same).withColumn(name, F.col(name) - F.col("_first") + 1)
    return numbered.select(*df.columns, name)


def micro_batch_ids(
    df: DataFrame, order: Sequence[str], size: int = 1000, within: Sequence[str] = ()
) -> DataFrame:
    """Batch 1, 2, … of ``size`` rows each, by ``order``, optionally per source partition."""
    numbered = with_ordinal(df, order, "_ordinal", within)
    return numbered.withColumn("batch_id", F.expr(f"(_ordinal - 1) div {int(size)} + 1")).drop(
        "_ordinal"
    )


def offset_batch_ids(df: DataFrame, offset: str, size: int = 1000) -> DataFrame:
    """As above for messages that carry dense offsets of their partition: no shuffle at all."""
    return df.withColumn("batch_id", F.expr(f"`{offset}` div {int(size)} + 1"))


def rotation_windows(df: DataFrame, ts: str, length: str = "60 seconds") -> DataFrame:
    """Start of the tumbling rotation window each row falls into."""
    return df.withColumn("window_start", F.window(F.col(ts), length)["start"])


def fan_out(df: DataFrame, copies: Column | int, name: str = "n", chunk: int = 10_000) -> DataFrame:
    """``copies`` rows per row, numbered 1, 2, … in ``name``.

    Numbers are made in chunks, so that no row ever builds an array longer than the chunk, and the
    chunks are dealt out over all tasks before they grow: a short frame may sit in one partition,
    and one row may ask for most of the copies.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = (copies if isinstance(copies, Column) else F.lit(copies)).cast("long")
    last_chunk = F.floor((F.col("_total") - 1) / F.lit(chunk))
    return (
        df.withColumn("_total", total)
        .filter(F.col("_total") >= 1)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
        .repartition(tasks)
        .withColumn(
            name,
            F.explode(
                F.sequence(
                    F.col("_chunk") * chunk + 1,
                    F.least((F.col("_chunk") + 1) * chunk, F.col("_total")),
                )
            ),
        )
        .drop("_total", "_chunk")
    )
