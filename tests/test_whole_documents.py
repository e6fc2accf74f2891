"""Documents in scratch tables and processed tables are written in one piece, arriving ones in files of bounded size."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from wardflow.documents.flatten import subtree, value
from wardflow.plans import queries_processed
from wardflow.session import materialize, shared_folder
from wardflow.streaming.upsert import ProcessedTable

SPEC = (value("id", "string", "id"), value("n", "int", "n"), subtree("raw_data"))


def _documents(spark, count: int):
    bodies = F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.col("id").alias("n"), F.lit("x").alias("note")))
    return spark.range(1, count + 1).select(F.col("id").cast("string").alias("id"), bodies.alias("resource_json"))


def _taken_apart(path) -> set[str]:
    files = [*Path(path).rglob("*.parquet")]
    assert files
    return {str(f) for f in files if "typed_value" in str(pq.ParquetFile(f).schema)}


def test_documents_are_written_in_one_piece(spark, tmp_path):
    setting = "spark.sql.variant.inferShreddingSchema"
    before = spark.conf.get(setting)
    texts = ['{"k": 1, "v": {"a": [1, "b", null]}}', "[]", "7", None]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, t string")
    rows = rows.select("k", F.parse_json("t").alias("doc"))
    kept = materialize(rows, "whole", f"{tmp_path}/scratch")
    table = ProcessedTable.create(rows, f"{tmp_path}/table", ["k"], buckets=2)
    table.apply(rows.withColumn("action", F.lit("INSERT")))
    again = rows.filter("k = '0'").select("k", F.parse_json(F.lit('{"k": 2}')).alias("doc"), F.lit("UPDATE").alias("action"))
    table.apply(again)
    assert not _taken_apart(f"{tmp_path}/scratch") and not _taken_apart(f"{tmp_path}/table/rows")
    assert spark.conf.get(setting) == before
    as_text = F.to_json("doc").alias("doc")
    said = ['{"k":1,"v":{"a":[1,"b",null]}}', "[]", "7", None]
    assert [r.doc for r in kept.orderBy("k").select("k", as_text).collect()] == said
    assert [r.doc for r in table.read().orderBy("k").select("k", as_text).collect()] == ['{"k":2}', *said[1:]]


def test_copies_are_written_in_files_of_bounded_size(spark, tmp_path):
    kept = materialize(spark.range(0, 20, 1, 1), "copies", f"{tmp_path}/copies", rows_per_file=7)
    assert sorted(pq.ParquetFile(f).metadata.num_rows for f in Path(f"{tmp_path}/copies").glob("*.parquet")) == [6, 7, 7]
    assert sorted(r.id for r in kept.collect()) == [*range(20)]


def test_arriving_documents_come_in_files_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(queries_processed, "DOCUMENTS_PER_FILE", 7)
    docs = _documents(spark, 50).coalesce(1)
    changed = docs.withColumn("resource_json", F.regexp_replace("resource_json", '"n":\\d+', '"n":0'))
    arrived = Path(shared_folder(spark)) / "wardflow"
    known = {*arrived.glob("arriving-*")}
    rows = queries_processed._merged(spark, docs, changed, SPEC, "id", ["id", "n"]).collect()
    found = {int(r.id): r.n for r in rows}
    assert found == {k: 0 if k % 10 in (1, 4, 7) else k for k in range(1, 51) if k % 10 not in (2, 8)}
    files = [f for folder in {*arrived.glob("arriving-*")} - known for f in folder.glob("action=*/*.gz")]
    lines = [spark.read.text(str(f)).count() for f in files]
    assert sum(lines) == 100 and max(lines) <= 7
