from __future__ import annotations

import json

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.schemas import CALLS
from wardflow.sinks.files import (
    clone_schema,
    load_by_position,
    publish,
    quarantine_union,
    truncate,
    write_resources,
)
from wardflow.sources.files import (
    from_folder,
    match_columns,
    read_documents,
    read_parquet_dir,
    read_resource,
)
from wardflow.sources.messages import (
    CORRUPT,
    decode_messages,
    encode_messages,
    header_line,
    split_corrupt,
)
from wardflow.sources.pages import explode_pages, first_records, read_pages


def page(*codes):
    return {"result": {"records": [{"PracticeCode": c, "GPPracticeName": f"N{c}"} for c in codes]}}


def landed(folder, *pages):
    for number, body in enumerate(pages):
        (folder / f"register-{number}.json").write_text(json.dumps(body, indent=1))
    return str(folder)


def test_all_records_of_landed_pages_are_kept(spark, tmp_path):
    path = landed(tmp_path, page(5, 4), page(3), page(), page(2, 9, 8))
    records = explode_pages(read_pages(spark, path))
    found = [(r.ordinal, r.PracticeCode) for r in records.orderBy("ordinal").collect()]
    assert found == [(1, 5), (2, 4), (3, 3), (4, 2), (5, 9), (6, 8)]
    assert [r.PracticeCode for r in first_records(records, 2).collect()] == [5, 4]


@pytest.mark.parametrize(
    ("pages", "reason"),
    [
        ((page(1, 2), page(3), page(4, 5)), "records after the last page"),
        ((page(1, 2), page(), page(3)), "records after the last page"),
        ((page(1, 2, 3),), "more than 2 records"),
    ],
)
def test_pages_that_do_not_fit_their_limit_fail(spark, tmp_path, pages, reason):
    with pytest.raises(Exception, match=reason):
        explode_pages(read_pages(spark, landed(tmp_path, *pages)), limit=2).collect()


def test_pages_within_their_limit(spark, tmp_path):
    path = landed(tmp_path, page(1, 2), page(3), page())
    assert explode_pages(read_pages(spark, path), limit=2).count() == 3


def test_parquet_by_name_pattern_and_column_name(spark, tmp_path):
    spark.createDataFrame([("1", 2.0)], "CALL_ID string, Score double").write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "notes.txt").write_text("not parquet")
    schema = T.StructType.fromDDL("call_id string, score int, extra date")
    held = T.StructType.fromDDL("call_id string, score double")
    row = read_parquet_dir(spark, str(tmp_path / "t"), schema, held).first()
    assert tuple(row) == ("1", 2, None)
    as_held = T.StructType.fromDDL("Call_Id string, extra date")
    assert tuple(read_parquet_dir(spark, str(tmp_path / "t"), as_held).first()) == ("1", None)
    assert match_columns(spark.range(1), T.StructType.fromDDL("ID string")).first().ID == "0"
    assert read_parquet_dir(spark, str(tmp_path / "t")).columns == ["CALL_ID", "Score"]


def test_documents_per_line_per_file_and_in_arrays(spark, tmp_path):
    appointments, patients = tmp_path / "Appointment", tmp_path / "Patient"
    appointments.mkdir()
    patients.mkdir()
    (appointments / "a.json").write_text('{"id": 1}\n\n{"id": 2}\n')
    (patients / "p.json").write_text('[{"id": 3}, {"id": 4}]')
    staged = read_documents(spark, str(tmp_path))
    assert staged.columns == ["folder_name", "raw_data", "load_timestamp"]
    ids = F.get_json_object("raw_data", "$.id").alias("id")
    assert sorted(r.id for r in from_folder(staged, "Appointment").select(ids).collect()) == ["1", "2"]
    assert sorted(r.id for r in from_folder(staged, "Patient").select(ids).collect()) == ["3", "4"]
    assert staged.filter(F.col("load_timestamp").isNull()).count() == 0
    (patients / "p.json").write_text(json.dumps([{"id": 5}, {"id": 6}], indent=2))
    whole = read_resource(spark, str(tmp_path), "Patient", one_per_file=True)
    assert sorted(r.id for r in whole.select(ids).collect()) == ["5", "6"]


def test_written_documents_can_be_read(spark, tmp_path):
    docs = spark.createDataFrame([("a", '{"id":"a"}')], "id string, resource_json string")
    write_resources(docs, str(tmp_path), "Endpoint")
    assert read_resource(spark, str(tmp_path), "Endpoint").first().raw_data == '{"id":"a"}'


def test_messages_keep_quotes_commas_and_line_breaks(spark):
    schema = T.StructType.fromDDL("id string, note string, n int, at timestamp")
    rows = spark.createDataFrame(
        [("1", 'say "hi", twice', 1, None), ("2", "back\\slash", None, None), ("3", None, 3, None)], schema
    ).withColumn("at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    lines = encode_messages(rows, quoted=["note"])
    assert lines.first().value == '1,"say ""hi"", twice",1,2024-01-02 03:04:05.000000'
    back, corrupt = split_corrupt(decode_messages(lines, schema))
    assert corrupt.count() == 0
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in rows.collect())


def test_lines_that_do_not_decode_are_kept(spark):
    lines = spark.createDataFrame(
        [(header_line(CALLS),), ("CL-1,P1,2024-01-01 00:00:00,query,resolved,general,5,n,Yes,4,East",)],
        "value string",
    )
    decoded = decode_messages(lines, CALLS)
    good, corrupt = split_corrupt(decoded)
    assert [r.call_id for r in good.collect()] == ["CL-1"]
    assert [r[CORRUPT] for r in corrupt.collect()] == [header_line(CALLS)]


def test_tables_by_position_cloned_and_truncated(spark, tmp_path):
    spark.sql("create table by_position (a string, b int) using parquet")
    load_by_position(spark.createDataFrame([(1, "x")], "n int, s string"), "by_position", ["s", "n"])
    assert tuple(spark.table("by_position").first()) == ("x", 1)
    spark.sql("drop table by_position")
    path = str(tmp_path / "clone")
    clone_schema(spark.createDataFrame([(1, "x")], "n int, s string"), path)
    assert spark.read.parquet(path).columns == ["n", "s"]
    spark.createDataFrame([(1, "x")], "n int, s string").write.mode("append").parquet(path)
    truncate(spark, path)
    assert (spark.read.parquet(path).count(), spark.read.parquet(path).columns) == (0, ["n", "s"])


def test_publishing_to_files(spark, tmp_path):
    publish(spark.createDataFrame([("a,b",)], "value string"), {"path": str(tmp_path / "topic")}, fmt="text")
    assert spark.read.text(str(tmp_path / "topic")).first().value == "a,b"


def test_quarantine_union_keeps_all_columns(spark):
    whole = quarantine_union(
        {"x": spark.range(1), "y": spark.range(1).withColumnRenamed("id", "other")}
    )
    assert whole.columns == ["id", "dataset", "other"]
