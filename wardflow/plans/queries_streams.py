"""Streaming jobs run to the end of their input; the result must equal the batch form."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.documents import specs
from wardflow.operators.merge import as_inserts
from wardflow.plans import standins as d
from wardflow.plans.catalog import query
from wardflow.plans.queries_changes import (
    CHANGES_SQL,
    TARGET_SQL,
    changes,
    merged_sql,
    processed,
)
from wardflow.plans.queries_rows import ROTATED_SQL
from wardflow.plans.standins import with_tables
from wardflow.schemas import CALLS, FEEDBACK, FEEDBACK_TABLE
from wardflow.session import scratch_path
from wardflow.sinks.files import write_resources
from wardflow.sources.history import load_history
from wardflow.sources.messages import encode_messages, message_stream
from wardflow.streaming.audit import load_audit
from wardflow.streaming.ingest import (
    append_stream,
    document_stream,
    file_stream,
    ingest_messages,
    load_files_stream,
    load_resource_stream,
    read_ingested,
    read_undecodable,
    write_csv_batches,
)
from wardflow.streaming.rotation import rotated_stream
from wardflow.streaming.upsert import ProcessedTable, merge_stream

_FEEDBACK = T.StructType(
    [
        T.StructField("feedback_id", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("feedback_type", T.StringType()),
        T.StructField("overall_score", T.DoubleType()),
    ]
)


def _lines(spark, sf_dir):
    """Events as a stream of feedback lines; errors lack their score.

    The pattern lets the table be one file or a folder of parts, which a plain stream path does not.
    """
    schema = d.table(spark, sf_dir, "events").schema
    events = file_stream(spark, f"{sf_dir}/events.parque[t]", schema)
    feedback = events.select(
        F.concat(F.lit("FB-"), F.col("event_id")).alias("feedback_id"),
        F.concat(F.lit("P"), F.col("user_id")).alias("patient_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("feedback_type"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("overall_score"),
        "file_name",
    )
    return encode_messages(feedback, keep=["file_name"])


_FEEDBACK_SQL = """
    select 'FB-' || event_id as feedback_id, 'P' || user_id as patient_id, ts as timestamp,
      event_type as feedback_type, value as overall_score
    from events where event_type <> 'error'"""


def _ingested(spark, sf_dir, outcome: str):
    path = scratch_path(spark, "ingest")
    job = ingest_messages(
        _lines(spark, sf_dir), _FEEDBACK, path, scratch_path(spark, "ingest-progress")
    )
    job.awaitTermination()
    return read_ingested(spark, path, _FEEDBACK, outcome)


@query("stream_ingest", _FEEDBACK_SQL)
def stream_ingest(spark, sf_dir):
    return _ingested(spark, sf_dir, "clean")


@query(
    "stream_ingest_missing",
    """
    select 'FB-' || event_id as feedback_id, 'P' || user_id as patient_id, ts as timestamp,
      event_type as feedback_type, cast(null as double) as overall_score
    from events where event_type = 'error'""",
)
def stream_ingest_missing(spark, sf_dir):
    return _ingested(spark, sf_dir, "missing")


@query(
    "stream_csv_batches",
    """
    select feedback_type, count(*) as row_count, count(overall_score) as scored_rows from (
      select event_type as feedback_type, case when event_type <> 'error' then value end as overall_score
      from events) group by feedback_type""",
)
def stream_csv_batches(spark, sf_dir):
    from wardflow.sources.files import read_csv_dir

    path = scratch_path(spark, "csv")
    job = write_csv_batches(
        _lines(spark, sf_dir), _FEEDBACK, path, scratch_path(spark, "csv-progress")
    )
    job.awaitTermination()
    rows = read_csv_dir(spark, f"{path}/*", _FEEDBACK)
    return rows.groupBy("feedback_type").agg(
        F.count("*").alias("row_count"), F.count("overall_score").alias("scored_rows")
    )


@query(
    "load_audit",
    """
    select 'feedback' as table_name, cast(0 as bigint) as batch_id, 'events.parquet' as table_file,
      count(*) as row_count, count(*) filter (where event_type = 'error') as reject_count
    from events""",
)
def load_audit_query(spark, sf_dir):
    audit = scratch_path(spark, "audit")
    job = ingest_messages(
        _lines(spark, sf_dir),
        _FEEDBACK,
        scratch_path(spark, "ingest"),
        scratch_path(spark, "ingest-progress"),
        audit=audit,
        table="feedback",
    )
    job.awaitTermination()
    noted = load_audit(spark, audit, "feedback").drop("loaded_at")
    # A table may be one file or a folder of parts.
    table_file = F.regexp_substr("file_name", F.lit("events[.]parquet")).alias("table_file")
    return noted.groupBy("table_name", "batch_id", table_file).agg(
        F.sum("row_count").alias("row_count"), F.sum("reject_count").alias("reject_count")
    )


def _change_files(spark, sf_dir) -> str:
    """The changes of all orders as files, each key in one of them."""
    path = scratch_path(spark, "change-files")
    changes(spark, sf_dir).repartitionByRange(3, "o_orderkey").write.parquet(path)
    return path


@query("stream_merge", f"with {TARGET_SQL}, {CHANGES_SQL} {merged_sql('changes')}")
def stream_merge(spark, sf_dir):
    start = processed(spark, sf_dir)
    table = ProcessedTable.create(start, scratch_path(spark, "processed"), ["o_orderkey"])
    table.apply(as_inserts(start))
    files = _change_files(spark, sf_dir)
    schema = spark.read.parquet(files).schema
    stream = file_stream(spark, files, schema, files_per_batch=1).drop("file_name")
    job = merge_stream(
        stream, table, scratch_path(spark, "merge-progress"), trigger={"availableNow": True}
    )
    job.awaitTermination()
    return table.read()


@query(
    "stream_load_organizations",
    with_tables(
        "practices",
        body="""
        select cast("PracticeCode" as varchar) as id, "GPPracticeName" as organization_name,
          "GPCluster" as state, 'http://' || lower(replace("GPPracticeName", ' ', '')) || '.com' as website
        from practices""",
    ),
)
def stream_load_organizations(spark, sf_dir):
    from wardflow.documents.build import build_organization

    root = scratch_path(spark, "store")
    docs = build_organization(
        d.practices(spark, sf_dir),
        {"family": F.lit("F"), "given": F.lit("G"), "phone": F.lit("0000")},
    )
    write_resources(docs, root, "Organization")
    path = scratch_path(spark, "organization")
    arriving = document_stream(spark, f"{root}/Organization")
    job = load_resource_stream(
        arriving, specs.ORGANIZATION, path, scratch_path(spark, "organization-progress")
    )
    job.awaitTermination()
    loaded = spark.read.parquet(path)
    return loaded.select("id", "organization_name", "state", "website")


@query(
    "staged_documents",
    with_tables(
        "practices",
        body="""
        select 'Endpoint' as folder, count(*) as document_count,
          count(*) filter (where "TelephoneNumber" is null) as without_number from practices
        union all
        select 'Organization', count(*), count(*) filter (where "TelephoneNumber" is null) from practices""",
    ),
)
def staged_documents(spark, sf_dir):
    """All documents of a store staged at once, then told apart by the folder they lie in."""
    from wardflow.documents.build import build_endpoint, build_organization
    from wardflow.sources.files import from_folder, read_documents

    root = scratch_path(spark, "store")
    practices = d.practices(spark, sf_dir)
    start = F.lit("2024-01-01").cast("date")
    inputs = {"family": F.lit("F"), "given": F.lit("G"), "phone": F.lit("none")}
    dates = {"status": F.lit("active"), "start": start, "end": start}
    write_resources(build_organization(practices, inputs), root, "Organization")
    write_resources(build_endpoint(practices, {**inputs, **dates}), root, "Endpoint")
    staged = read_documents(spark, root)

    def counted(folder: str, number_path: str):
        number = F.get_json_object("raw_data", number_path)
        return from_folder(staged, folder).agg(
            F.lit(folder).alias("folder"),
            F.count("*").alias("document_count"),
            F.count_if(number == "none").alias("without_number"),
        )

    return counted("Endpoint", "$.contact[0].value").unionByName(
        counted("Organization", "$.contact[0].telecom[1].value")
    )


@query("array_file_streamed", "select o_orderkey, o_orderpriority, o_totalprice from orders")
def array_file_streamed(spark, sf_dir):
    """Orders in files of one array each, laid out over several lines, read document by document."""
    from wardflow.sources.arrays import read_array_files

    note = F.lit('a } brace, a "quote" and a \\').alias("note")
    orders = d.table(spark, sf_dir, "orders").withColumn("part", F.expr("o_orderkey div 20000"))
    fields = F.struct("o_orderkey", "o_orderpriority", "o_totalprice", note)
    arrays = orders.groupBy("part").agg(F.to_json(F.collect_list(fields), {"pretty": "true"}).alias("value"))
    path = scratch_path(spark, "array-files")
    arrays.write.partitionBy("part").text(path)
    body = F.from_json("raw_data", "o_orderkey long, o_orderpriority string, o_totalprice double")
    return read_array_files(spark, path).select(body.alias("d")).select("d.*")


@query("stream_rotated_batches", ROTATED_SQL)
def stream_rotated_batches(spark, sf_dir):
    """Events as one consumer batches them as they arrive: the numbers of the batch form."""
    schema = d.table(spark, sf_dir, "events").schema
    events = file_stream(spark, f"{sf_dir}/events.parque[t]", schema).select("event_id", "ts")
    path = scratch_path(spark, "rotated")
    numbered = rotated_stream(events, "ts", ["event_id"], None, 20, 3600, 25 * 60).select("event_id", "batch_id")
    append_stream(numbered, path, scratch_path(spark, "rotated-progress")).awaitTermination()
    return spark.read.schema("event_id long, batch_id long").parquet(path)


@query(
    "stream_ingest_corrupt",
    """
    select case event_id % 10 when 0 then 'undecodable' when 1 then 'missing' else 'clean' end as outcome,
      count(*) as row_count, sum(case when event_id % 10 = 0 then length(event_id::varchar) + 2 else 0 end)::bigint as bytes
    from events group by all""",
)
def stream_ingest_corrupt(spark, sf_dir):
    """Feedback lines among which some are no text at all and some have a word for their score."""
    events, topic, path = d.table(spark, sf_dir, "events"), scratch_path(spark, "topic"), scratch_path(spark, "ingest")
    line = F.concat_ws(",", F.concat(F.lit("FB-"), F.col("event_id")), F.lit("P1"), F.lit("2024-01-02 03:04:05"), "event_type", "value")
    broken = F.concat(F.col("event_id").cast("string").cast("binary"), F.unhex(F.lit("C3FF")))
    value = F.when(F.col("event_id") % 10 == 0, broken.cast("string")).when(F.col("event_id") % 10 == 1, F.concat(line, F.lit("x"))).otherwise(line)
    events.select(value.alias("value")).write.text(topic)
    stream = message_stream(spark, {"path": topic}, "text")
    ingest_messages(stream, _FEEDBACK, path, scratch_path(spark, "ingest-progress")).awaitTermination()
    good = [read_ingested(spark, path, _FEEDBACK, o).select(F.lit(o).alias("outcome"), F.lit(0).alias("size")) for o in ("clean", "missing")]
    bad = read_undecodable(spark, path).select(F.lit("undecodable").alias("outcome"), F.octet_length("message").alias("size"))
    return good[0].unionByName(good[1]).unionByName(bad).groupBy("outcome").agg(
        F.count("*").alias("row_count"), F.sum("size").alias("bytes")
    )


def _piped(spark, rows, schema, file_schema, table):
    """Three Parquet files and one that is none, loaded two files at a time; rows, and files by status."""
    folder, path, notes = (scratch_path(spark, name) for name in ("pipe", "piped", "history"))
    rows.repartition(3).write.parquet(folder)
    rows.limit(1).select(F.lit("no table").alias("value")).write.mode("append").text(folder)
    load_files_stream(
        spark, folder, schema, path, scratch_path(spark, "pipe-progress"), notes, table, file_schema, "part-*", files_per_batch=2
    ).awaitTermination()
    failed = load_history(spark, notes, table).filter("status = 'failed'").agg(F.count("*")).scalar()
    return spark.read.schema(schema).parquet(path).withColumn("failed_files", failed)


@query(
    "stream_pipe_calls",
    with_tables("calls", body="select call_id, call_duration, cast(1 as bigint) as failed_files from calls"),
)
def stream_pipe_calls(spark, sf_dir):
    calls = d.calls(spark, sf_dir)
    return _piped(spark, calls, CALLS, None, "calls").select("call_id", "call_duration", "failed_files")


@query(
    "stream_pipe_feedback",
    """select 'FB-' || event_id as feedback_id, cast(trunc(value) as integer) as overall_score, cast(1 as bigint) as failed_files
    from events""",
)
def stream_pipe_feedback(spark, sf_dir):
    """Overall scores are numbers with a fraction in the files and whole ones in the table."""
    events = d.table(spark, sf_dir, "events")
    rows = events.select(F.concat(F.lit("FB-"), "event_id").alias("feedback_id"), F.col("value").alias("overall_score"))
    loaded = _piped(spark, rows, FEEDBACK_TABLE, FEEDBACK, "feedback")
    return loaded.select("feedback_id", "overall_score", "failed_files")
