"""Kept snapshots with digests, and tables kept in buckets."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wardflow.operators.keys import bucketed_table, skip_processed
from wardflow.operators.merge import BUCKET, kept_snapshot_changes, snapshot_changes, write_snapshot

COLUMNS = "id int, v string, w string, l array<string>"
OLD = [(i, f"v{i}", None, ["a", None]) for i in range(60)] + [(None, "n", None, None), (None, "n", "x", [])]


def changed(spark, tmp_path, old, new, buckets=16):
    frames = [spark.createDataFrame(rows, COLUMNS) for rows in (old, new)]
    paths = [str(tmp_path / name) for name in ("old", "new")]
    for frame, path in zip(frames, paths):
        write_snapshot(frame, path, ["id"], buckets)
    found = kept_snapshot_changes(spark, *paths, frames[0].schema, ["id"])
    plain = snapshot_changes(*frames, ["id"])
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    return found


def test_kept_snapshots_change_as_others_do(spark, tmp_path):
    new = OLD[5:] + [(100, "new", None, None)]
    new[7] = (12, None, "v12", ["a", None])
    new[20] = (25, "v25", None, ["a", ""])
    new[30] = (35, "v35", None, [None, "a"])
    assert changed(spark, tmp_path, OLD, new).filter("id is not null").count() == 5 + 1 + 3


def test_empty_and_equal_snapshots(spark, tmp_path):
    assert changed(spark, tmp_path / "a", [], []).count() == 0
    assert changed(spark, tmp_path / "b", [], OLD[:3]).count() == 3
    assert changed(spark, tmp_path / "c", OLD[:3], []).count() == 3
    assert changed(spark, tmp_path / "d", OLD[:60], list(reversed(OLD[:60]))).count() == 0


def test_repeated_rows_do_not_cancel_out(spark, tmp_path):
    twice = [[(1, v, None, None)] * 2 for v in "ab"]
    assert changed(spark, tmp_path, *twice, buckets=1).count() == 4


def test_only_changed_buckets_are_read(spark, tmp_path):
    new = [(i, "other" if i == 7 else f"v{i}", None, ["a", None]) for i in range(60)]
    changed(spark, tmp_path, OLD[:60], new)
    home = spark.range(1).select(F.pmod(F.xxhash64(F.lit(7)), F.lit(16))).first()[0]
    for file in tmp_path.glob("*/rows/*/*.parquet"):
        if file.parent.name != f"{BUCKET}={home}":
            file.write_bytes(b"not to be read")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    schema = spark.createDataFrame([], COLUMNS).schema
    found = kept_snapshot_changes(spark, str(tmp_path / "old"), str(tmp_path / "new"), schema, ["id"])
    assert [(r.id, r.v, r.action) for r in found.collect()] == [(7, "other", "UPDATE")]


def test_a_snapshot_that_was_not_finished_cannot_be_read(spark, tmp_path):
    frame = spark.createDataFrame(OLD, COLUMNS)
    write_snapshot(frame, str(tmp_path / "old"), ["id"], 4)
    frame.write.parquet(str(tmp_path / "new" / "rows"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        kept_snapshot_changes(spark, str(tmp_path / "old"), str(tmp_path / "new"), frame.schema, ["id"])


def test_bucketed_tables_are_matched_without_a_shuffle(spark, tmp_path):
    name = "spark.sql.autoBroadcastJoinThreshold"
    stored = bucketed_table(spark.range(200), "stored_ids", str(tmp_path / "stored"), "id", 8)
    nulls = spark.range(2).select(F.lit(None).cast("long").alias("id"))
    bucketed_table(nulls, "stored_ids", str(tmp_path / "stored"), "id", 8)
    bucketed_table(spark.range(50), "done_ids", str(tmp_path / "done"), "id", 8)
    done = bucketed_table(spark.range(50, 150), "done_ids", str(tmp_path / "done"), "id", 8)
    stored = spark.table("stored_ids")
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        left = skip_processed(stored, done, "id")
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
        assert sorted(str(r.id) for r in left.collect()) == sorted(["None"] * 2 + [str(i) for i in range(150, 200)])
    finally:
        spark.conf.set(name, before)
        spark.sql("drop table stored_ids")
        spark.sql("drop table done_ids")
