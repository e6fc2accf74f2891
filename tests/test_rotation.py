"""Batches by count, time and idleness against the consumer's loop."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest

from wardflow.operators.rotation import rotated_batches
from wardflow.streaming.ingest import append_stream
from wardflow.streaming.rotation import rotated_stream

START = datetime(2024, 3, 1)


def consumed(times, size, seconds, idle):
    """One message after the other, as a consumer sees them; ``times`` in seconds."""
    found, batch, held, clock, last = [], 1, 0, None, None
    times, seconds, idle = [round(t * 1e6) for t in times], seconds * 1e6, None if idle is None else idle * 1e6
    for t in times:
        if last is not None and idle is not None and t - last > idle:
            if held:
                batch += 1
            held, clock = 0, None
        clock = t if clock is None else clock
        held += 1
        found.append(batch)
        last = t
        if held >= size or t - clock >= seconds:
            batch, held, clock = batch + 1, 0, t
    return found


def table(spark, times):
    rows = [(k, START + timedelta(seconds=t), "x") for k, t in enumerate(times)]
    return spark.createDataFrame(rows, "id int, ts timestamp, _n string").repartition(5)


@pytest.mark.parametrize("seed", range(5))
def test_like_the_consumer(spark, seed):
    draw = random.Random(seed)
    times, t = [], 0.0
    for _ in range(900):
        t += draw.choice([0, 0, 0.5, 1, 3, 9, 10, 10.000001, 25, 200]) if seed % 2 else draw.choice([0, 0.1, 0.2, 8])
        times.append(t)
    size, seconds, idle = [(7, 20, 10), (40, 5, None), (1, 60, 10), (50, 30, 1000), (13, 0.3, 5)][seed]
    found = rotated_batches(table(spark, times).withColumnRenamed("_n", "word"), "ts", ["id"], size, seconds, idle, span=64).collect()
    assert [r.batch_id for r in sorted(found, key=lambda r: r.id)] == consumed(times, size, seconds, idle)


def test_one_range_and_missing_times(spark):
    docs = spark.createDataFrame([(1, START), (2, None), (3, START), (4, START + timedelta(seconds=70))], "id int, ts timestamp")
    found = {r.id: r.batch_id for r in rotated_batches(docs, "ts", ["id"], 10, 60, None).collect()}
    assert found == {1: 1, 2: None, 3: 1, 4: 1}
    assert rotated_batches(docs.filter("false"), "ts", ["id"]).collect() == []
    with pytest.raises(ValueError):
        rotated_batches(docs, "ts", ["id"], 0)


def test_stream_over_micro_batches(spark, tmp_path):
    """State carries an open batch from file to file; each consumer has batches of its own."""
    draw, times, t = random.Random(8), [], 0.0
    for _ in range(240):
        t += draw.choice([0.5, 1, 3, 12])
        times.append(t)
    (tmp_path / "in").mkdir()
    for part in range(3):
        lines = [f"{k},{START + timedelta(seconds=times[k])},c{k % 2}" for k in range(part * 80, part * 80 + 80)]
        draw.shuffle(lines)
        (tmp_path / "in" / f"{part}.csv").write_text("\n".join([*lines, f"{900 + part},,c0"]))
        os.utime(tmp_path / "in" / f"{part}.csv", (1_700_000_000 + part,) * 2)
    stream = spark.readStream.schema("id int, ts timestamp, who string").option("maxFilesPerTrigger", 1).csv(str(tmp_path / "in"))
    numbered = rotated_stream(stream, "ts", ["id"], "who", 9, 20, 10)
    append_stream(numbered, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    found = {r.id: r.batch_id for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    for who in (0, 1):
        own = [k for k in range(240) if k % 2 == who]
        assert [found[k] for k in own] == consumed([times[k] for k in own], 9, 20, 10)
    assert [found[k] for k in (900, 901, 902)] == [None] * 3
