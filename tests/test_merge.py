from __future__ import annotations

import itertools
import pathlib

import pytest
from pyspark.sql import functions as F

from wardflow.operators.keys import latest_per_key, orphans, skip_processed
from wardflow.operators.merge import (
    as_inserts,
    empty_like,
    merge_changes,
    put_resources,
    snapshot_changes,
)
from wardflow.session import discard, shared_folder
from wardflow.streaming.ingest import file_stream
from wardflow.streaming.upsert import ProcessedTable, merge_stream

COLUMNS = "id int, v string"
CHANGES = "id int, v string, action string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def expected_merge(target, changes):
    """The merge rules, one change at a time; only for tiny inputs."""
    table = dict(target)
    for key, value, action in changes:
        if action == "INSERT":
            table.setdefault(key, value)
        elif action == "UPDATE" and key in table:
            table[key] = value
        elif action == "DELETE":
            table.pop(key, None)
    return sorted(table.items(), key=str)


ALL_CASES = [
    (k, f"new{k}", action) for k, action in enumerate(["INSERT", "UPDATE", "DELETE"] * 2 + ["OTHER", None])
]
TARGET = [(0, "old0"), (1, "old1"), (2, "old2"), (6, "old6"), (7, "old7"), (9, "old9")]


def test_every_case_of_the_merge(spark):
    target = spark.createDataFrame(TARGET, COLUMNS)
    changes = spark.createDataFrame(ALL_CASES, CHANGES)
    assert rows(merge_changes(target, changes, ["id"])) == expected_merge(TARGET, ALL_CASES)


def test_newest_change_of_a_key_counts(spark):
    target = spark.createDataFrame(TARGET, COLUMNS)
    changes = spark.createDataFrame(
        [(1, "a", "UPDATE", 1), (1, "b", "UPDATE", 3), (1, "c", "DELETE", 2), (5, "x", "DELETE", 1),
         (5, "y", "INSERT", 2)],
        CHANGES + ", seq int",
    )
    found = merge_changes(target, changes, ["id"], seq_col="seq")
    assert rows(found) == expected_merge(TARGET, [(1, "b", "UPDATE"), (5, "y", "INSERT")])


def test_rows_without_a_key_match_nothing(spark):
    target = spark.createDataFrame([(None, "t1"), (None, "t2"), (1, "old")], COLUMNS)
    changes = spark.createDataFrame(
        [(None, "c1", "INSERT"), (None, "c2", "UPDATE"), (None, "c3", "DELETE"), (1, "n", "UPDATE")],
        CHANGES,
    )
    assert rows(merge_changes(target, changes, ["id"])) == sorted(
        [(None, "t1"), (None, "t2"), (None, "c1"), (1, "n")], key=str
    )


def test_composite_key(spark):
    target = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "x int, y string, v int")
    changes = spark.createDataFrame(
        [(1, "a", 9, "UPDATE"), (2, "a", 7, "INSERT")], "x int, y string, v int, action string"
    )
    assert rows(merge_changes(target, changes, ["x", "y"])) == [(1, "a", 9), (1, "b", 2), (2, "a", 7)]


def test_documents_can_be_merged(spark):
    target = spark.createDataFrame([(1, '{"a":1}')], COLUMNS).withColumn("doc", F.parse_json("v"))
    changes = (
        spark.createDataFrame([(1, '{"a":2}', "UPDATE", 1), (2, '{"a":3}', "INSERT", 1)], CHANGES + ", seq int")
        .withColumn("doc", F.parse_json("v"))
    )
    found = merge_changes(target, changes, ["id"], seq_col="seq")
    values = found.select("id", F.variant_get("doc", "$.a", "int").alias("a"))
    assert rows(values) == [(1, 2), (2, 3)]
    later = target.withColumn("doc", F.parse_json(F.lit('{"a":5}')))
    assert [r.action for r in snapshot_changes(target, later, ["id"]).collect()] == ["UPDATE"]


def test_snapshots_to_changes_and_back(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], COLUMNS)
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (5, None)], COLUMNS)
    changes = snapshot_changes(old, new, ["id"])
    assert {r.id: r.action for r in changes.collect()} == {
        2: "UPDATE", 3: "UPDATE", 4: "DELETE", 5: "INSERT",
    }
    assert rows(merge_changes(old, changes, ["id"])) == rows(new)


def test_last_put_wins(spark):
    store = spark.createDataFrame([("a", "1"), ("b", "1")], "id string, doc string")
    puts = spark.createDataFrame(
        [("b", "2", 1), ("b", "3", 2), ("c", "1", 1)], "id string, doc string, at int"
    )
    found = put_resources(store, puts, ["id"], ["at"])
    assert rows(found) == [("a", "1"), ("b", "3"), ("c", "1")]
    assert rows(put_resources(found, puts, ["id"], ["at"])) == rows(found)


def test_latest_per_key_does_not_depend_on_order(spark):
    versions = [(1, 5, "x"), (1, 5, "y"), (1, 4, "z"), (None, 1, "n"), (None, 2, "m")]
    expected = sorted([(1, 5, "y"), (None, 1, "n"), (None, 2, "m")], key=str)
    for arrangement in itertools.islice(itertools.permutations(versions), 0, 120, 41):
        df = spark.createDataFrame(list(arrangement), "k int, seq int, v string")
        assert rows(latest_per_key(df, ["k"], ["seq"])) == expected


def test_group_limit_comes_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as seq", "id as v")
    plan = latest_per_key(df, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_orphans_and_processed_ids(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "ref string")
    parent = spark.createDataFrame([("b",)], "id string")
    assert rows(orphans(child, "ref", parent, "id")) == sorted([("a", 2), (None, 1)], key=str)
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "id string, v int")
    assert rows(skip_processed(df, parent, "id")) == sorted([("a", 1), ("a", 2), (None, 4)], key=str)
    assert empty_like(df).schema == df.schema


@pytest.fixture
def table(spark, tmp_path):
    like = spark.createDataFrame([], COLUMNS)
    return ProcessedTable.create(like, str(tmp_path / "processed"), ["id"], max_segments=4, buckets=3)


def test_processed_table_over_many_batches(spark, table):
    model: list = []
    assert rows(table.read()) == []
    for batch in range(12):
        changes = [
            ((batch * 7 + i) % 25, f"b{batch}", ["INSERT", "UPDATE", "DELETE", "INSERT"][i % 4])
            for i in range(8)
        ]
        assert table.apply(spark.createDataFrame(changes, CHANGES), batch)
        model = expected_merge(model, changes)
        assert rows(table.read()) == sorted(model, key=str)
        assert len(table._newest().segments) <= 3 * 4


def segments(table):
    return {(r.bucket, r.version) for r in table._newest().segments}


def test_pure_inserts_rewrite_nothing(spark, table):
    table.apply(spark.createDataFrame([(1, "a", "INSERT")], CHANGES), 0)
    before = segments(table)
    table.apply(spark.createDataFrame([(2, "b", "INSERT"), (1, "z", "INSERT")], CHANGES), 1)
    assert before < segments(table)
    assert rows(table.read()) == [(1, "a"), (2, "b")]


def test_a_change_of_one_key_rewrites_one_bucket(spark, table):
    table.apply(spark.createDataFrame([(i, "a", "INSERT") for i in range(30)], CHANGES), 0)
    before = segments(table)
    assert len(before) == 3
    table.apply(spark.createDataFrame([(7, "b", "UPDATE")], CHANGES), 1)
    assert len(before - segments(table)) == 1
    assert rows(table.read()) == sorted([(i, "b" if i == 7 else "a") for i in range(30)], key=str)


MIXED_TARGET = [(1, "old"), (2, "old"), (3, "old"), (None, "old")]
MIXED = [
    (1, "i", "INSERT"), (1, "u", "UPDATE"), (2, "i", "INSERT"), (2, None, "DELETE"), (3, "i", "INSERT"),
    (3, "j", "INSERT"), (4, "i", "INSERT"), (4, "u", "UPDATE"), (5, "i", "INSERT"), (5, "i", "INSERT"),
    (6, "u", "UPDATE"), (None, "n", "INSERT"), (None, "n", "INSERT"), (None, "u", "UPDATE"),
]
MIXED_RESULT = sorted(
    [(1, "u"), (3, "old"), (4, "i"), (5, "i"), (5, "i"), (None, "old"), (None, "n"), (None, "n")], key=str
)


def test_inserts_beside_other_changes_of_their_key(spark):
    target = spark.createDataFrame(MIXED_TARGET, COLUMNS)
    assert rows(merge_changes(target, spark.createDataFrame(MIXED, CHANGES), ["id"])) == MIXED_RESULT


@pytest.mark.parametrize("max_segments", [1, 32])
def test_compaction_changes_no_row(spark, tmp_path, max_segments):
    target = spark.createDataFrame(MIXED_TARGET, COLUMNS)
    table = ProcessedTable.create(target, str(tmp_path / "t"), ["id"], max_segments, buckets=2)
    table.apply(as_inserts(target))
    table.apply(spark.createDataFrame(MIXED, CHANGES))
    assert rows(table.read()) == MIXED_RESULT


def test_two_updates_of_a_key_fail_the_merge(spark):
    target = spark.createDataFrame([(1, "old")], COLUMNS)
    twice = spark.createDataFrame([(1, "x", "UPDATE"), (1, "y", "DELETE")], CHANGES)
    with pytest.raises(Exception, match="several updates or deletes of one key"):
        merge_changes(target, twice, ["id"]).collect()


def test_copies_without_a_key_are_kept_either_way(spark):
    target = spark.createDataFrame([(1, "old")], COLUMNS)
    copies = spark.createDataFrame([(None, "n", "INSERT", 1)] * 2, CHANGES + ", seq int")
    for seq in (None, "seq"):
        assert rows(merge_changes(target, copies, ["id"], seq_col=seq)).count((None, "n")) == 2


def test_expired_versions_are_deleted(spark, table):
    for k in range(3):
        table.apply(spark.createDataFrame([(1, f"v{k}", "UPDATE" if k else "INSERT")], CHANGES))
    assert table.expire(before=0) == 0
    assert table.expire(before=float("inf")) == 3
    assert rows(table.read()) == [(1, "v2")]
    kept = {p.parent.name for p in pathlib.Path(table.path).glob("rows/*/_bucket=*")}
    assert kept == {"version=3"}
    assert rows(ProcessedTable(spark, table.path, ["id"]).read()) == [(1, "v2")]


def test_replayed_and_empty_batches_change_nothing(spark, table):
    changes = spark.createDataFrame([(1, "a", "INSERT")], CHANGES)
    assert table.apply(changes, 0) is True
    assert table.apply(spark.createDataFrame([(1, "b", "UPDATE")], CHANGES), 0) is False
    assert table.apply(empty_like(changes), 1) is False
    assert rows(table.read()) == [(1, "a")]
    again = ProcessedTable(spark, table.path, ["id"])
    assert again.apply(spark.createDataFrame([(1, "b", "UPDATE")], CHANGES), 0) is False
    assert again.apply(spark.createDataFrame([(1, "b", "UPDATE")], CHANGES), 2) is True
    assert rows(table.read()) == [(1, "b")]


def test_repeated_keys_in_a_batch(spark, table):
    inserts = spark.createDataFrame([(1, "a", "INSERT"), (2, "b", "INSERT"), (2, "c", "INSERT")], CHANGES)
    table.apply(inserts)
    assert rows(table.read()) == [(1, "a"), (2, "b"), (2, "c")]
    twice = spark.createDataFrame([(1, "x", "UPDATE"), (1, None, "DELETE")], CHANGES)
    with pytest.raises(ValueError, match="updates or deletes of one key"):
        table.apply(twice)
    # One change may meet several rows of its key.
    table.apply(spark.createDataFrame([(2, "z", "UPDATE")], CHANGES))
    assert rows(table.read()) == [(1, "a"), (2, "z"), (2, "z")]
    ordered = twice.withColumn("seq", F.when(F.col("v") == "x", 2).otherwise(1))
    table.apply(ordered, seq_col="seq")
    assert rows(table.read()) == [(1, "x"), (2, "z"), (2, "z")]


def test_snapshots_with_rows_without_a_key(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b")], COLUMNS)
    new = spark.createDataFrame([(None, "a"), (1, "b")], COLUMNS)
    found = snapshot_changes(old, new, ["id"])
    assert sorted(r.action for r in found.collect()) == ["DELETE", "INSERT"]


def test_scratch_tables_of_a_batch_are_removed(spark, table):
    def scratch():
        folder = pathlib.Path(shared_folder(spark)) / "wardflow"
        return {p.name for p in folder.glob("*")} if folder.exists() else set()

    before = scratch()
    table.apply(spark.createDataFrame([(1, "a", "INSERT")], CHANGES))
    assert scratch() == before
    assert rows(table.read()) == [(1, "a")]
    with pytest.raises(ValueError, match="not a scratch path"):
        discard(spark, table.path)


def test_batches_are_counted_per_source(spark, table):
    first = spark.createDataFrame([(1, "a", "INSERT")], CHANGES)
    assert table.apply(first, 5, source="one") is True
    assert table.apply(spark.createDataFrame([(2, "b", "INSERT")], CHANGES), 5, source="one") is False
    assert table.apply(spark.createDataFrame([(2, "b", "INSERT")], CHANGES), 0, source="two") is True
    assert rows(table.read()) == [(1, "a"), (2, "b")]


def test_a_segment_left_by_a_failed_batch_is_replaced(spark, table):
    table.apply(spark.createDataFrame([(1, "a", "INSERT")], CHANGES), 0)
    stray = spark.createDataFrame([(99, "stray")], COLUMNS)
    stray.write.parquet(f"{table.path}/rows/version=2/_bucket=0")
    assert rows(table.read()) == [(1, "a")]
    table.apply(spark.createDataFrame([(2, "b", "INSERT")], CHANGES), 1)
    assert rows(table.read()) == [(1, "a"), (2, "b")]


def test_merge_stream_is_idempotent(spark, tmp_path, table):
    source = str(tmp_path / "changes")
    progress = str(tmp_path / "progress")

    def run():
        stream = file_stream(spark, source, spark.createDataFrame([], CHANGES).schema).drop("file_name")
        merge_stream(stream, table, progress, trigger={"availableNow": True}).awaitTermination()

    first = [(1, "a", "INSERT"), (2, "b", "INSERT")]
    second = [(1, "A", "UPDATE"), (2, None, "DELETE"), (3, "c", "INSERT")]
    for changes in (first, second):
        spark.createDataFrame(changes, CHANGES).coalesce(1).write.mode("append").parquet(source)
        run()
        run()
    assert rows(table.read()) == [(1, "A"), (3, "c")]


def test_append_only_feed(spark):
    assert as_inserts(spark.range(1)).first().action == "INSERT"
