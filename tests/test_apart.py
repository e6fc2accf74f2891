"""Rows written apart by a column."""

from __future__ import annotations

from pyspark.sql.classic.dataframe import DataFrame

from wardflow.documents.rules import RULES, write_checked
from wardflow.sinks.files import write_apart

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def test_checked_documents_are_not_sorted_by_outcome(spark, tmp_path, monkeypatch):
    """Spark sorts a task's rows before it parts them unless several files may be open."""
    seen, real = [], DataFrame.write.fget
    monkeypatch.setattr(DataFrame, "write", property(lambda df: (seen.append(spark.conf.get(WRITERS)), real(df))[1]))
    docs = spark.createDataFrame([("1", "{}"), ("2", None)], "id string, resource_json string")
    before = spark.conf.get(WRITERS)
    assert write_checked(docs, RULES["Organization"], str(tmp_path / "out")) == {"valid": 0, "rejected": 2}
    assert seen and all(int(n) > 1 for n in seen)
    assert spark.conf.get(WRITERS) == before


def test_more_values_than_open_files(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 2).selectExpr("id", "cast(id % 9 as int) as kind").repartition(2)
    write_apart(rows, "kind", str(tmp_path / "out"), "append")
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.id, r.kind) for r in found) == [(n, n % 9) for n in range(1000)]
