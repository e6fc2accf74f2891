"""Batches that close by count, by time or by idleness, as a consumer closes them message by message.

The rule is sequential: a batch closes at the first message that is its ``size``-th or that comes ``seconds``
or more after the message that closed the batch before; a gap of more than ``idle`` seconds closes it as well,
and the clock starts again with the message after the gap. Where a batch that began at some message would
end depends on no earlier batch, though, so all these ends are found at once; which messages do begin
batches follows from jumping along them: inside ranges of messages in tasks of their own, from range
to range by jumps that double.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.operators.ordinals import with_ordinal
from wardflow.session import materialize

#: Messages of one range; a range is never smaller than a batch.
RANGE = 100_000


def rotated_batches(
    df: DataFrame, ts: str, order: Sequence[str], size: int = 1000, seconds: float = 60, idle: float | None = 10, span: int = RANGE
) -> DataFrame:
    """``df`` with ``batch_id`` (1, 2, …), batches following each other by ``ts`` and ``order``.

    ``ts`` and ``order`` together must identify a row; rows without a time are in no batch and have a null
    number. The first message starts the clock. ``idle=None`` turns that rule off.
    """
    if size < 1 or seconds <= 0:
        raise ValueError("a batch holds a message at least and lasts longer than no time")
    span = max(span, size)
    timed = df.filter(F.col(f"`{ts}`").isNotNull())
    rows = materialize(with_ordinal(timed, [ts, *order], "_n"), "rotation-rows")
    links = materialize(_links(rows.select("_n", _micros(F.col(f"`{ts}`")).alias("at")), size, seconds, idle, span), "rotation-links")
    numbers = _numbers(links, _entries(links, span))
    late = df.filter(F.col(f"`{ts}`").isNull()).withColumn("batch_id", F.lit(None).cast("long"))
    return rows.join(numbers, "_n").select(*[F.col(f"`{c}`") for c in df.columns], "batch_id").unionByName(late)


def _micros(when: Column) -> Column:
    return F.unix_micros(when.cast("timestamp"))


def _links(rows: DataFrame, size: int, seconds: float, idle: float | None, span: int) -> DataFrame:
    """``range, n, next``: a batch that begins at message ``n`` is followed by one that begins at ``next``."""
    before = rows.select((F.col("_n") + 1).alias("_n"), F.col("at").alias("before"))
    timed = rows.join(before, "_n", "left")
    gap = F.lit(False) if idle is None else (F.col("at") - F.col("before") > round(idle * 1e6))
    begins = F.col("before").isNull() | gap
    clock = F.when(begins, F.col("at")).otherwise(F.col("before"))
    timed = timed.select("_n", "at", begins.alias("begins"), (clock + round(seconds * 1e6)).alias("due"))
    timed = materialize(timed, "rotation-times")
    # Dues in one order with times: what stands before a due is the dues before it, which are as many as its
    # own number tells since dues ascend, and the messages that come before it is due.
    due = timed.select(F.col("due").alias("at"), F.lit(0).alias("kind"), "_n")
    both = with_ordinal(due.unionByName(timed.select("at", F.lit(1).alias("kind"), "_n")), ["at", "kind", "_n"], "_place")
    closing = both.filter("kind = 0").select("_n", (F.col("_place") - F.col("_n") + 1).alias("closing"))
    linked = timed.select("_n", "begins").join(closing, "_n")
    linked = linked.select("_n", "begins", F.least(F.col("closing") + 1, F.col("_n") + size).alias("next"))
    return _cut_at_gaps(linked.withColumn("range", F.expr(f"(_n - 1) div {span}")), span)


def _cut_at_gaps(linked: DataFrame, span: int) -> DataFrame:
    """Links that end at the next message after a gap at the latest; one row per range is looked at together."""
    ahead = W.partitionBy("range").orderBy("_n").rowsBetween(1, W.unboundedFollowing)
    start = F.when(F.col("begins"), F.col("_n"))
    firsts = linked.groupBy("range").agg(F.min(start).alias("first"))
    later = W.orderBy("range").rowsBetween(1, W.unboundedFollowing)
    firsts = firsts.select(F.col("range"), F.min("first").over(later).alias("later"))
    cut = linked.withColumn("here", F.min(start).over(ahead)).join(firsts, "range")
    return cut.select("range", F.col("_n").alias("n"), F.least("next", "here", "later").alias("next"))


def _entries(links: DataFrame, span: int) -> DataFrame:
    """``range, entry``: the first batch that begins in each range (a batch may be the only one of two ranges)."""
    first = links.filter("n = 1").select("range", F.col("n").alias("entry"))
    exits = links.groupBy("range").applyInArrow(_exits, "exit long").distinct()
    met = exits.select(F.expr(f"(exit - 1) div {span}").alias("range"), F.col("exit").alias("entry")).unionByName(first)
    jumps = links.groupBy("range").cogroup(met.groupBy("range")).applyInArrow(_jumps, "entry long, exit long")
    jumps = materialize(jumps, "rotation-jumps")
    nodes = jumps.select("entry")
    reached = materialize(first.select("entry"), "rotation-reached")
    while True:
        found = reached.join(jumps, "entry").select(F.col("exit").alias("entry"))
        found = found.join(nodes, "entry", "left_semi").join(reached, "entry", "left_anti")
        found = materialize(found.distinct(), "rotation-found")
        if found.isEmpty():
            return reached.select(F.expr(f"(entry - 1) div {span}").alias("range"), "entry")
        reached = reached.unionByName(found)
        further = jumps.select(F.col("entry").alias("exit"), F.col("exit").alias("further"))
        jumps = materialize(jumps.join(further, "exit").select("entry", F.col("further").alias("exit")), "rotation-jumps")


def _numbers(links: DataFrame, entries: DataFrame) -> DataFrame:
    """``_n, batch_id`` from where the batches of each range begin."""
    walked = links.groupBy("range").cogroup(entries.groupBy("range")).applyInArrow(_walk, "range long, n long, nth long")
    walked = materialize(walked, "rotation-batches")
    counts = walked.groupBy("range").agg(F.max("nth").alias("batches"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("range", F.coalesce(F.sum("batches").over(before), F.lit(0)).alias("begun"))
    return walked.join(starts, "range").select(F.col("n").alias("_n"), (F.col("nth") + F.col("begun")).alias("batch_id"))


def _sorted(links: pa.Table) -> tuple[int, np.ndarray]:
    """The first message of a range, and the links of all in order."""
    n, following = links.column("n").to_numpy(), links.column("next").to_numpy()
    return int(n.min()), following[np.argsort(n)]


def _leaving(links: pa.Table) -> tuple[int, np.ndarray]:
    """For each message of a range where the batches that begin at it leave the range."""
    first, following = _sorted(links)
    out = following.copy()
    end = first + len(out)
    # Links ascend and lead forward, so doubling them ends after as many steps as the longest walk has bits.
    while (inside := out < end).any():
        out[inside] = out[out[inside] - first]
    return first, out


def _exits(links: pa.Table) -> pa.Table:
    return pa.table({"exit": np.unique(_leaving(links)[1])})


def _jumps(links: pa.Table, met: pa.Table) -> pa.Table:
    entry = np.unique(met.column("entry").to_numpy())
    if not links.num_rows or not len(entry):
        return pa.table({"entry": np.zeros(0, np.int64), "exit": np.zeros(0, np.int64)})
    first, out = _leaving(links)
    entry = entry[entry < first + len(out)]  # the last batch leads behind the last message
    return pa.table({"entry": entry, "exit": out[entry - first]})


def _walk(links: pa.Table, entries: pa.Table) -> pa.Table:
    first, following = _sorted(links)
    begins = np.zeros(len(following), np.int64)
    at = int(entries.column("entry").to_numpy().min()) if entries.num_rows else first + len(following)
    while at < first + len(following):
        begins[at - first] = 1
        at = int(following[at - first])
    where = np.full(len(begins), links.column("range")[0].as_py(), np.int64)
    return pa.table({"range": where, "n": np.arange(first, first + len(begins)), "nth": np.cumsum(begins)})
