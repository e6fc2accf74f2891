"""Every registered query against independent SQL on the same tables."""

from __future__ import annotations

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from wardflow.plans import catalog

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def comparable(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(comparable(row[i]) for i in order) for row in rows)


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz", "TIMESTAMP_NS": "timestamp_ntz", "DATE": "date",
    "BOOLEAN": "boolean",
}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(name, spark, sf_dir, database):
    found = entry_points.queries()[name](spark, sf_dir)
    expected = database.execute(entry_points.oracle_sql()[name])
    names = [c[0] for c in expected.description]
    kinds = [str(c[1]) for c in expected.description]
    assert sorted(found.columns) == sorted(names)
    types = dict(found.dtypes)
    assert {n: types[n] for n in names} == {n: KINDS[k] for n, k in zip(names, kinds)}
    expected_rows = rows_by_name(names, expected.fetchall())
    assert rows_by_name(found.columns, found.collect()) == expected_rows
    assert expected_rows


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.CHECKS)
    assert set(catalog.QUERIES) <= set(entry_points.queries())


def test_entry_returns_rows(spark):
    found = entry_points.entry(spark)
    assert found.columns == ["patient_name", "average_satisfaction_score", "total_calls"]
    assert found.count() > 0
