from __future__ import annotations

import pytest

import __spark_entry__
from wardflow.plans import queries_documents

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "EUROPE")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "FRANCE", 0)]),
    "supplier": (
        "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
        [(1, "Supplier 1", 1, 10.0), (2, "Supplier 2", 1, 6000.0)],
    ),
    "events": (
        "event_id bigint, user_id bigint, event_type string, ts timestamp_ntz, value double",
        [(k, k, "view", None, 1.0) for k in range(25)],
    ),
}


@pytest.fixture
def tables(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_documents_of_both_rounds_are_built_of_copies_made_once(spark, tables, monkeypatch):
    numbered = []
    real = queries_documents.with_ordinal

    def counted(*args, **kwargs):
        numbered.append(args[1])
        return real(*args, **kwargs)

    monkeypatch.setattr(queries_documents, "with_ordinal", counted)
    rows = __spark_entry__.QUERIES["processed_condition"](spark, tables).collect()
    assert numbered == [["event_id"]]
    assert {r["id"][-1] for r in rows} == set("01345679")
    assert len(rows) == len({r["id"] for r in rows}) == 25 - 5
    assert all((r["verification_status"] == "confirmed") for r in rows if r["id"][-1] in "147")
