from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.quality import (
    cast_or_reject,
    round_columns,
    split_counts,
    split_missing,
    write_parted,
    write_split,
)
from wardflow.plans import jobs
from wardflow.schemas import CALLS, FEEDBACK, FEEDBACK_SCORES, QUARANTINE
from wardflow.sinks.files import append_if_any, append_quarantine, append_rows, read_quarantine
from wardflow.sources.files import read_csv_dir, read_csv_text

CALL_HEADER = ",".join(CALLS.names)
CALL_LINES = [
    'CL-001,P1-01,2024-01-02 03:04:05,query,resolved,general,5,"Booked, twice.",Yes,4,East',
    "CL-002,P1-01,2024-01-02 03:04:05,query,resolved,general,5,note,Yes,,East",
    'CL-003,P1-02,2024-01-02 03:04:05,query,resolved,general,5,"",Yes,3,East',
    CALL_HEADER,
    "CL-004,P1-02,not a time,query,resolved,general,5,note,Yes,3,East",
]


def write_lines(path, header, lines):
    path.mkdir(parents=True)
    (path / "batch_0.csv").write_text("\n".join([header, *lines]))
    return str(path)


def test_calls_with_gaps_quotes_and_a_second_header(spark, tmp_path):
    source = write_lines(tmp_path / "in", CALL_HEADER, CALL_LINES)
    calls = read_csv_dir(spark, source + "/*.csv", CALLS)
    clean, missing = split_missing(calls)
    assert [r.notes for r in clean.collect()] == ["Booked, twice."]
    # The empty cell, the quoted empty cell, the header line and the bad time.
    assert sorted(r.call_id for r in missing.collect()) == ["CL-002", "CL-003", "CL-004", "call_id"]
    assert split_counts(calls).first().asDict() == {
        "total_rows": 5, "clean_rows": 1, "missing_rows": 4,
    }


def test_nan_counts_as_missing(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, float("nan")), (3, None)], "id int, score double")
    clean, missing = split_missing(rows)
    assert [r.id for r in clean.collect()] == [1]
    assert sorted(r.id for r in missing.collect()) == [2, 3]
    clean, missing = split_missing(rows, ["id"])
    assert (clean.count(), missing.count()) == (3, 0)


def test_split_is_written_in_one_pass(spark, tmp_path):
    rows = spark.range(10).select("id", F.when(F.col("id") > 3, F.col("id")).alias("v"))
    counts = write_split(rows, str(tmp_path / "out"))
    assert counts == {"clean": 6, "missing": 4}
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.filter("outcome = 'clean'").count() == 6
    assert back.filter("v is null").select("outcome").distinct().collect()[0][0] == "missing"


def test_rounding_keeps_type_and_rounds_halves_away_from_zero(spark):
    rows = spark.createDataFrame([(6.5, 7), (-0.5, 8), (2.4, 9)], "a double, b int")
    found = round_columns(rows, ["a", "b"])
    assert [tuple(r) for r in found.collect()] == [(7.0, 7), (-1.0, 8), (2.0, 9)]
    assert found.schema == rows.schema


def test_casts_that_lose_a_value_are_rejected(spark, tmp_path):
    header = "id,score,when"
    source = write_lines(tmp_path / "in", header, ["1,5,2024-01-01", "x,5,2024-01-01", "2,,soon"])
    schema = T.StructType.fromDDL("id int, score int, when date")
    good, rejects = cast_or_reject(read_csv_text(spark, source, schema), schema)
    assert [(r.id, r.score) for r in good.collect()] == [(1, 5)]
    assert {r.id: r.bad_columns for r in rejects.collect()} == {"x": ["id"], "2": ["when"]}


def test_quarantine_holds_both_schemas(spark, tmp_path):
    path = str(tmp_path / "missing")
    calls = spark.createDataFrame([("CL-1", None)], "call_id string, notes string")
    feedback = spark.createDataFrame([("FB-1", None, 1)], "feedback_id string, comments string, s int")
    assert append_quarantine(calls, path, "calls") == 1
    assert append_quarantine(feedback, path, "feedback") == 1
    rows = read_quarantine(spark, path)
    assert {"call_id", "notes", "feedback_id", "comments", "s", "dataset"} == set(rows.columns)
    assert rows.filter("dataset = 'feedback'").first().call_id is None


def test_appending_nothing(spark, tmp_path):
    nothing = spark.range(0)
    assert append_if_any(nothing, str(tmp_path / "a")) is False
    assert not (tmp_path / "a").exists()
    assert append_rows(nothing, str(tmp_path / "b")) == 0
    assert append_if_any(spark.range(3), str(tmp_path / "a")) is True


FEEDBACK_LINES = [
    'FB-00001,P1-01,2024-01-02 03:04:05,praise,call,general,"East, A","Fine, thanks.",5,6,7,8,6.5,Yes',
    'FB-00002,P1-01,2024-01-02 03:04:05,praise,call,general,"East","Fine.",5,6,7,,6.0,Yes',
]


def test_jobs_from_files_to_tables(spark, tmp_path):
    calls = write_lines(tmp_path / "calls", CALL_HEADER, CALL_LINES)
    feedback = write_lines(tmp_path / "feedback", ",".join(FEEDBACK.names), FEEDBACK_LINES)
    quarantine = str(tmp_path / "missing")
    call_out, feedback_out = str(tmp_path / "call_out"), str(tmp_path / "feedback_out")
    assert jobs.process_calls(spark, calls, call_out, quarantine) == jobs.Outcome(1, 4)
    assert jobs.process_feedback(spark, feedback, feedback_out, quarantine) == jobs.Outcome(1, 1)
    assert read_quarantine(spark, quarantine).count() == 5
    kept = read_quarantine(spark, quarantine, QUARANTINE)
    assert kept.groupBy("dataset").count().count() == 2
    assert kept.filter("feedback_id = 'FB-00002' and resolution_score is null").count() == 1
    assert jobs.load_calls(spark, call_out).schema.names == CALLS.names
    row = jobs.load_feedback(spark, feedback_out).first()
    assert (row.call_centre, row.overall_score) == ("East, A", 7)


def test_inferred_schema_is_still_possible(spark, tmp_path):
    feedback = write_lines(tmp_path / "feedback", ",".join(FEEDBACK.names), FEEDBACK_LINES)
    types = dict(read_csv_dir(spark, feedback).dtypes)
    assert types["overall_score"] == "double"
    assert types["resolution_score"] == "int"


def test_clean_job_without_clean_rows_writes_nothing(spark, tmp_path):
    calls = write_lines(tmp_path / "calls", CALL_HEADER, CALL_LINES[1:3])
    out = tmp_path / "out"
    outcome = jobs.process_calls(spark, calls, str(out), str(tmp_path / "missing"))
    assert outcome == jobs.Outcome(0, 2)
    assert not out.exists()


def test_loading_keeps_what_fits_and_rejects_the_rest(spark, tmp_path):
    rows = [("CL-1", "3", "5"), ("CL-2", "three", "5"), (None, None, None)]
    source = tmp_path / "in"
    files = "CALL_ID string, satisfaction_score string, call_duration string"
    spark.createDataFrame(rows, files).write.parquet(str(source))
    (source / "broken.parquet").write_text("not parquet at all")
    held = T.StructType.fromDDL(files.lower())
    good = jobs.load_or_reject(spark, str(source), CALLS, held, str(tmp_path / "rejects"))
    assert good.schema == CALLS
    assert sorted((r.call_id, r.satisfaction_score) for r in good.collect() if r.call_id) == [("CL-1", 3)]
    assert good.count() == 2
    rejected = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [(r.call_id, r.bad_columns) for r in rejected] == [("CL-2", ["satisfaction_score"])]


def test_quarantined_scores_stay_as_they_came(spark, tmp_path):
    rows = spark.createDataFrame([(1, 6.5, None), (2, 6.5, "x")], "id int, score double, note string")
    counts = write_parted(
        rows, str(tmp_path / "clean"), str(tmp_path / "missing"), "t", str(tmp_path / "staging"), ["score"]
    )
    assert counts == {"clean": 1, "missing": 1}
    assert spark.read.parquet(str(tmp_path / "clean")).first().score == 7.0
    kept = spark.read.parquet(str(tmp_path / "missing")).first()
    assert (kept.score, kept.dataset) == (6.5, "t")


def test_the_source_is_scanned_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.range(10).selectExpr("id", "nullif(id % 3, 0) as v").mapInArrow(count, "id long, v long")
    write_parted(rows, str(tmp_path / "c"), str(tmp_path / "q"), "t", str(tmp_path / "s"))
    assert reads.value == 10
