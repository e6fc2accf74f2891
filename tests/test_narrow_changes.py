"""What a merge does not have to carry around."""

from __future__ import annotations

from wardflow.operators.merge import merge_changes, one_per_key
from wardflow.streaming.upsert import ProcessedTable


def test_deletes_carry_no_values(spark):
    changes = spark.createDataFrame([("a", "long text", "DELETE"), ("b", None, "UPDATE"), ("c", "x", "INSERT")], "k string, v string, action string")
    found = {r.k: (r._action, r._new) for r in one_per_key(changes, ["k"], ["k", "v"]).collect()}
    assert found == {"a": ("DELETE", None), "b": ("UPDATE", ("b", None))}
    target = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, v string")
    assert sorted(merge_changes(target, changes, ["k"]).collect()) == [("b", None), ("c", "3")]


def test_an_empty_table_is_not_joined(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "k string, v int")
    table = ProcessedTable.create(rows, str(tmp_path / "t"), ["k"], buckets=2)
    held = table._rows(table._newest(), [0, 1])
    plan = rows.join(held.select("k"), "k", "left_anti")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    table.apply(rows.selectExpr("*", "'INSERT' as action"))
    assert sorted(r.v for r in table.read().collect()) == [1, 2, 3]
