"""Notes of loads: files that are half broken, several loads a day, zones ahead of UTC, streams begun again."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wardflow.plans import jobs
from wardflow.schemas import CALLS
from wardflow.sources import history
from wardflow.streaming.audit import load_audit, note_unreadable
from wardflow.streaming.ingest import ingest_messages

SCHEMA = "n long, word string"


@pytest.fixture
def folder(spark, tmp_path):
    rows = spark.range(4000).select(F.col("id").alias("n"), F.concat(F.lit("w"), F.col("id")).alias("word"))
    options = {"parquet.block.row.count.limit": "100", "compression": "none"}
    for name in ("good", "half"):
        rows.coalesce(1).write.options(**options).parquet(str(tmp_path / "in" / name))
    rows.filter("false").coalesce(1).write.parquet(str(tmp_path / "in" / "void"))
    (half,) = (tmp_path / "in" / "half").glob("*.parquet")
    data = bytearray(half.read_bytes())
    data[len(data) // 2 : len(data) // 2 + 600] = b"#" * 600
    half.write_bytes(data)
    (tmp_path / "in" / "half" / f".{half.name}.crc").unlink()
    for name, content in {"cut": bytes(data[: len(data) // 3]), "none": b"\n", "text": b"PAR1 but no table PAR1"}.items():
        (tmp_path / "in" / f"{name}.parquet").write_bytes(content)
    return str(tmp_path / "in")


def by_name(notes):
    return {r.file_name.rsplit("/in/", 1)[1].split("/")[0].split(".")[0]: r for r in notes}


def test_every_file_is_noted(spark, folder, tmp_path):
    notes = str(tmp_path / "notes")
    rows = history.load_files(spark, folder, spark.createDataFrame([], SCHEMA).schema, notes, "words")
    found = by_name(history.load_history(spark, notes).collect())
    assert {k: r.status for k, r in found.items()} == {
        "good": "loaded", "void": "loaded", "half": "partly loaded", "cut": "failed", "none": "failed", "text": "failed",
    }
    assert found["good"].rows_read == found["good"].rows_expected == found["half"].rows_expected == 4000
    assert 0 < found["half"].rows_read < 4000
    assert found["void"].rows_expected == 0 and found["cut"].rows_expected is None
    assert rows.count() == sum(r.rows_read for r in found.values())
    assert rows.columns == ["n", "word"]


def test_two_loads_a_day_leave_two_notes_each(spark, folder, tmp_path):
    notes, schema = str(tmp_path / "notes"), spark.createDataFrame([], SCHEMA).schema
    for _ in range(2):
        history.load_files(spark, folder, schema, notes, "words")
    found = history.load_history(spark, notes, "words")
    assert found.count() == 12 and found.select("run_id").distinct().count() == 2
    assert history.load_history(spark, notes, "other").count() == 0
    assert history.load_history(spark, notes, hours=0).count() == 0


def test_a_clean_load_does_not_erase_notes(spark, tmp_path):
    audit = str(tmp_path / "audit")
    files = spark.createDataFrame([("a",), ("b",)], "file_name string")
    note_unreadable(files, audit, "calls")
    note_unreadable(files.filter("false"), audit, "calls")
    note_unreadable(files, audit, "calls")
    assert load_audit(spark, audit, "calls-unreadable").count() == 4


@pytest.mark.parametrize("zone", ["Pacific/Auckland", "Asia/Tokyo", "America/Los_Angeles"])
def test_session_zones(spark, folder, tmp_path, zone):
    """Whatever the zone's day, notes of the last hours are in the folders that are read."""
    notes, audit = str(tmp_path / "notes"), str(tmp_path / "audit")
    history.load_files(spark, folder, spark.createDataFrame([], SCHEMA).schema, notes, "words")
    note_unreadable(spark.createDataFrame([("a",)], "file_name string"), audit, "words")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for hours in range(1, 25):
            assert history.load_history(spark, notes, hours=hours).count() == 6
            assert load_audit(spark, audit, hours=hours).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_loads_of_calls_are_noted(spark, tmp_path):
    notes, clean = str(tmp_path / "notes"), str(tmp_path / "clean")
    spark.createDataFrame([], CALLS).coalesce(1).write.parquet(clean)
    assert jobs.load_calls(spark, clean, notes).columns == CALLS.names
    assert [(r.table_name, r.status) for r in history.load_history(spark, notes).collect()] == [("calls", "loaded")]


def test_a_stream_begun_again_is_another_run(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "0.txt").write_text("x\n")
    audit = str(tmp_path / "audit")

    def run(checkpoint):
        lines = spark.readStream.text(str(tmp_path / "topic")).withColumn("file_name", F.col("_metadata.file_path"))
        out = str(tmp_path / f"out-{checkpoint}")
        ingest_messages(lines, CALLS, out, str(tmp_path / checkpoint), audit=audit, table="calls").awaitTermination()

    for checkpoint in ("first", "second", "first"):
        run(checkpoint)
    # The third run had nothing new; the second is another stream, with a batch 0 of its own.
    assert [r.batch_id for r in load_audit(spark, audit, "calls").collect()] == [0, 0]
    runs = {p.name for p in (tmp_path / "audit").glob("*/*/run_id=*")}
    ids = {r for c in ("first", "second") for r in [(tmp_path / c / "metadata").read_text().split('"')[3]]}
    assert runs == {f"run_id={r}" for r in ids}
