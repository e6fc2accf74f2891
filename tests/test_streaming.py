from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.documents import specs
from wardflow.operators.quality import split_missing
from wardflow.schemas import CALLS
from wardflow.sources.files import read_csv_dir
from wardflow.sources.messages import header_line, message_stream
from wardflow.streaming.audit import load_audit
from wardflow.streaming.ingest import (
    append_stream,
    document_stream,
    file_stream,
    ingest_messages,
    load_resource_stream,
    read_ingested,
    read_undecodable,
    write_csv_batches,
)

LINE = 'CL-{n:03d},P1-01,2024-01-02 03:04:05,query,resolved,general,{n},"Booked, twice.",Yes,4,East'


def write_topic(path, name, numbers, header=False):
    path.mkdir(parents=True, exist_ok=True)
    lines = ([header_line(CALLS)] if header else []) + [LINE.format(n=n) for n in numbers]
    (path / name).write_text("\n".join(lines) + "\n")


def messages(spark, path, per_batch=None):
    options = {"path": str(path)}
    if per_batch:
        options["maxFilesPerTrigger"] = str(per_batch)
    return message_stream(spark, options, fmt="text")


def test_ingest_equals_batch_and_rerun_adds_nothing(spark, tmp_path):
    topic = tmp_path / "topic"
    write_topic(topic, "0.txt", range(1, 6), header=True)
    write_topic(topic, "1.txt", range(6, 9))
    out, progress, audit = (str(tmp_path / n) for n in ("out", "progress", "audit"))

    def run():
        stream = messages(spark, topic, per_batch=1).withColumn(
            "file_name", F.col("_metadata.file_path")
        )
        ingest_messages(stream, CALLS, out, progress, audit=audit, table="calls").awaitTermination()

    run()
    run()
    clean = read_ingested(spark, out, CALLS, "clean")
    assert sorted(r.call_duration for r in clean.collect()) == list(range(1, 9))
    # The header line published with the data is not a complete row.
    missing = read_ingested(spark, out, CALLS, "missing")
    assert missing.count() == 1
    noted = load_audit(spark, audit, "calls")
    assert sorted((r.row_count, r.reject_count) for r in noted.collect()) == [(3, 0), (6, 1)]
    assert sorted(r.batch_id for r in noted.collect()) == [0, 1]
    assert load_audit(spark, audit, "calls", hours=0).count() == 0
    assert load_audit(spark, audit, "feedback").count() == 0
    write_topic(topic, "2.txt", [9])
    run()
    assert read_ingested(spark, out, CALLS, "clean").count() == 9


def test_csv_batches_have_headers_and_read_back(spark, tmp_path):
    topic = tmp_path / "topic"
    write_topic(topic, "0.txt", [1, 2], header=True)
    write_topic(topic, "1.txt", [3])
    out = tmp_path / "csv"
    audit = str(tmp_path / "audit")
    job = write_csv_batches(
        messages(spark, topic, 1), CALLS, str(out), str(tmp_path / "progress"), audit, "calls"
    )
    job.awaitTermination()
    noted = {r.file_name: r.row_count for r in load_audit(spark, audit, "calls").collect()}
    assert set(noted) == {f"{out}/batch_id=0", f"{out}/batch_id=1"}
    assert sorted(noted.values()) == [1, 3]
    assert sorted(p.name for p in out.iterdir()) == ["batch_id=0", "batch_id=1"]
    for file in out.glob("*/part-*.csv"):
        assert file.read_text().splitlines()[0] == header_line(CALLS)
    clean, missing = split_missing(read_csv_dir(spark, f"{out}/*", CALLS))
    assert sorted(r.call_id for r in clean.collect()) == ["CL-001", "CL-002", "CL-003"]
    assert [r.notes for r in clean.collect()] == ["Booked, twice."] * 3
    assert missing.count() == 1


def test_files_are_taken_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.range(1).schema

    def run():
        stream = file_stream(spark, source, schema, glob="*.parquet")
        append_stream(stream, out, str(tmp_path / "progress")).awaitTermination()

    spark.range(3).coalesce(1).write.parquet(source)
    run()
    run()
    spark.range(3, 5).coalesce(1).write.mode("append").parquet(source)
    run()
    found = spark.read.parquet(out)
    assert sorted(r.id for r in found.collect()) == [0, 1, 2, 3, 4]
    assert found.select("file_name").distinct().count() == 2


def test_documents_arrive_as_a_stream(spark, tmp_path):
    source = tmp_path / "Endpoint"
    source.mkdir()
    (source / "a.json").write_text('[{"id": "x", "header": ["X"]}, {"id": "y"}]')
    out = str(tmp_path / "out")
    job = load_resource_stream(
        document_stream(spark, str(source)), specs.ENDPOINT, out, str(tmp_path / "progress")
    )
    job.awaitTermination()
    found = {r.id: r.organization_name for r in spark.read.parquet(out).collect()}
    assert found == {"x": "X", "y": None}


def test_bad_documents_of_a_stream_are_kept_apart(spark, tmp_path):
    source = tmp_path / "Endpoint"
    source.mkdir()
    good, bad = '{"id": "x", "period": {"start": "2024-01-01"}}', '{"id": "y", "period": {"start": "soon"}}'
    (source / "a.json").write_text(good + "\n" + bad + "\n")
    out, rejects = str(tmp_path / "out"), str(tmp_path / "rejects")
    job = load_resource_stream(
        document_stream(spark, str(source)), specs.ENDPOINT, out, str(tmp_path / "progress"), rejects
    )
    job.awaitTermination()
    assert [r.id for r in spark.read.parquet(out).collect()] == ["x"]
    assert [r.bad_columns for r in spark.read.parquet(rejects).collect()] == [["start_date"]]


def test_messages_that_are_no_text_are_kept_with_their_place(spark, tmp_path):
    topic = tmp_path / "topic"
    write_topic(topic, "0.txt", [1, 2])
    with (topic / "0.txt").open("ab") as file:
        file.write(b"CL-\xff\xfe,x\n\xc3\n")
    audit = str(tmp_path / "audit")
    stream = messages(spark, topic).select(
        "value", F.lit("calls").alias("topic"), F.lit(3).alias("partition"), F.lit(7).cast("long").alias("offset"),
        F.col("_metadata.file_path").alias("file_name"),
    )
    ingest_messages(stream, CALLS, str(tmp_path / "out"), str(tmp_path / "progress"), audit=audit, table="calls").awaitTermination()
    found = read_undecodable(spark, str(tmp_path / "out")).collect()
    assert sorted(bytes(r.message) for r in found) == [b"CL-\xff\xfe,x", b"\xc3"]
    assert {(r.topic, r.partition, r.offset, r.file_name.rsplit("/", 1)[1]) for r in found} == {("calls", 3, 7, "0.txt")}
    assert read_ingested(spark, str(tmp_path / "out"), CALLS, "clean").count() == 2
    assert read_ingested(spark, str(tmp_path / "out"), CALLS, "missing").count() == 0
    assert [(r.row_count, r.reject_count) for r in load_audit(spark, audit, "calls").collect()] == [(4, 2)]
