"""The numbered copies that documents are built from."""

from __future__ import annotations

from wardflow.plans.queries_documents import copies


def tables(spark, path, orders):
    """Three practices and some orders."""
    columns = {
        "supplier": ["id + 1 as s_suppkey", "concat('S', id) as s_name", "id % 2 as s_nationkey", "3000.0 as s_acctbal"],
        "nation": ["id as n_nationkey", "concat('N', id) as n_name", "0L as n_regionkey"],
        "region": ["id as r_regionkey", "'R' as r_name"],
        "orders": ["id * 10 as o_orderkey", "id % 3 as o_custkey"],
    }
    for name, count in (("supplier", 3), ("nation", 2), ("region", 1), ("orders", orders)):
        spark.range(count).selectExpr(*columns[name]).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_copies_are_not_broadcast(spark, tmp_path):
    """The copies come from few practices, but there are as many as rows of the table."""
    found = copies(spark, tables(spark, tmp_path, 5000), "orders", "o_orderkey")
    rows = found.collect()
    assert sorted(r.o_orderkey for r in rows) == [10 * k for k in range(5000)]
    assert all(r.PracticeCode == (r.counter - 1) // 1667 + 1 and r.o_orderkey == 10 * (r.counter - 1) for r in rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [counter" in plan
    assert "HashJoin [counter" not in plan
