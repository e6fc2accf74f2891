"""Batches of a stream that close by count, by time or by idleness, kept in state between micro-batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = "batch long, held long, clock long, last long"

#: About as many messages as are sorted and numbered at once.
SLICE = 100_000


def rotated_stream(
    messages: DataFrame,
    ts: str,
    order: Sequence[str],
    consumer: str | None = None,
    size: int = 1000,
    seconds: float = 60,
    idle: float = 10,
) -> DataFrame:
    """The messages with ``batch_id`` by the rule of ``operators.rotation``, in order of ``ts`` and ``order``.

    ``consumer`` names a column: the messages of each of its values are batched by themselves, as those of
    a topic's partitions are by consumers of their own; without it one consumer reads them all, in one task,
    which holds a micro-batch's messages once and sorts and numbers them by slices.
    Messages arrive in order, within a micro-batch they are sorted. That a batch closed by idleness shows when
    the next message comes, with the same number that a timer would have given it (and a timer would
    keep a run that ends with its input from ending). Messages without a time have a null number.
    """
    key = F.lit("") if consumer is None else F.col(f"`{consumer}`").cast("string")
    found = messages.withColumn("_consumer", F.coalesce(key, F.lit("")))
    found = found.withColumn("_at", F.unix_micros(F.col(f"`{ts}`").cast("timestamp")))
    schema = T.StructType([*messages.schema.fields, T.StructField("batch_id", T.LongType())])
    rule = _rule(messages.columns, list(order), size, round(seconds * 1e6), round(idle * 1e6))
    return found.groupBy("_consumer").applyInPandasWithState(rule, schema, _STATE, "append", GroupStateTimeout.NoTimeout)


def _rule(columns: list[str], order: list[str], size: int, seconds: int, idle: int):
    def run(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch, held, clock, last = state.get if state.exists else (1, 0, None, None)
        timed, untimed = [], []
        for part in parts:
            known = part["_at"].notna()
            if known.any():
                timed.append(part[known].astype({"_at": "int64"}).sort_values("_at", kind="stable"))
            if not known.all():
                untimed.append(part.loc[~known, columns])
        for rows in _in_order(timed, ["_at", *order]):
            numbers = np.empty(len(rows), np.int64)
            for n, at in enumerate(rows["_at"].tolist()):
                if last is not None and at - last > idle:
                    batch, held, clock = batch + (held > 0), 0, None
                clock, held, last, numbers[n] = at if clock is None else clock, held + 1, at, batch
                if held >= size or at - clock >= seconds:
                    batch, held, clock = batch + 1, 0, at
            yield rows[columns].assign(batch_id=numbers)
        state.update((batch, held, clock, last))
        for rows in untimed:
            yield rows.assign(batch_id=pd.array([None] * len(rows), "Int64"))

    return run


def _in_order(parts: list[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of parts that are sorted by ``_at``, in order, some at a time: messages are held once as
    they came, and only a slice of time is put together and sorted. Equal times stay in one slice."""
    times = [part["_at"].to_numpy() for part in parts]
    step = max(1, SLICE // 64)
    marks = np.sort(np.concatenate([t[::64] for t in times])) if times else np.empty(0, np.int64)
    cuts = np.unique(marks[step::step])
    begins = [0] * len(parts)
    for cut in [*cuts.tolist(), None]:
        ends = [len(t) if cut is None else int(np.searchsorted(t, cut)) for t in times]
        held = [part.iloc[a:b] for part, a, b in zip(parts, begins, ends, strict=True) if a < b]
        begins = ends
        if held:
            yield pd.concat(held).sort_values(by, kind="stable")
