"""The end-to-end jobs over files made from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.documents import build, specs
from wardflow.documents.rules import FAIL, NONE, RULES, require_rows, validate, write_checked
from wardflow.operators.merge import empty_like
from wardflow.plans import jobs, reports
from wardflow.plans import standins as d
from wardflow.plans.catalog import query
from wardflow.plans.queries_documents import appointments, copies_sql, patients
from wardflow.plans.standins import with_tables
from wardflow.schemas import CALLS, FEEDBACK, FEEDBACK_SCORES, QUARANTINE
from wardflow.session import materialize, scratch_path
from wardflow.sinks.files import (
    load_by_position,
    read_quarantine,
    truncate,
    write_resources,
)
from wardflow.sources import history
from wardflow.sources.files import read_csv_dir, read_parquet_dir, read_resource, unreadable_files
from wardflow.streaming.audit import load_audit, note_unreadable
from wardflow.streaming.ingest import document_stream, load_resource_stream
from wardflow.streaming.upsert import ProcessedTable


def _call_files(spark, sf_dir) -> str:
    """All calls as CSV files with a header line; unspecified centres and pending scores are empty."""
    calls = d.gappy_calls(spark, sf_dir)
    full = calls.withColumns(
        {
            "call_type": F.lit("query"),
            "department": F.lit("general"),
            "notes": F.concat(F.lit('Said "yes", then '), F.col("resolution_status")),
            "follow_up_required": F.lit("No"),
        }
    )
    path = scratch_path(spark, "call-files")
    full.select(*CALLS.names).write.options(header=True, escape='"').csv(path)
    return path


def _processed_calls(spark, sf_dir):
    """Calls through all stages: files, split, call table, processed table."""
    clean, quarantine = scratch_path(spark, "calls"), scratch_path(spark, "quarantine")
    jobs.process_calls(spark, _call_files(spark, sf_dir), clean, quarantine)
    loaded = jobs.load_calls(spark, clean)
    table = ProcessedTable.create(loaded, scratch_path(spark, "processed-calls"), ["call_id"])
    jobs.refresh(table, loaded)
    return table.read(), read_quarantine(spark, quarantine, QUARANTINE)


_COMPLETE = "call_centre is not null and satisfaction_score is not null"


@query(
    "calls_end_to_end",
    with_tables(
        "gappy_calls",
        body=f"""
        select call_id, patient_id, timestamp, call_centre, call_duration, satisfaction_score,
          'Said "yes", then ' || resolution_status as notes
        from gappy_calls where {_COMPLETE}""",
    ),
)
def calls_end_to_end(spark, sf_dir):
    processed, _ = _processed_calls(spark, sf_dir)
    return processed.select(
        "call_id",
        "patient_id",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        "call_centre",
        "call_duration",
        "satisfaction_score",
        "notes",
    )


@query(
    "quarantined_calls",
    with_tables(
        "gappy_calls",
        body=f"select 'calls' as dataset, call_id from gappy_calls where not ({_COMPLETE})",
    ),
)
def quarantined_calls(spark, sf_dir):
    return _processed_calls(spark, sf_dir)[1].select("dataset", "call_id")


@query(
    "feedback_end_to_end",
    """
    select 'FB-' || event_id as feedback_id, cast(round(value) as integer) as overall_score,
      cast(event_id % 6 + 5 as integer) as satisfaction_score
    from events where event_type <> 'error'""",
)
def feedback_end_to_end(spark, sf_dir):
    """Feedback files to rounded rows of the feedback table, whose overall score is whole."""
    score = (F.col("event_id") % 6 + 5).cast("int")
    events = d.table(spark, sf_dir, "events").select(
        F.concat(F.lit("FB-"), F.col("event_id")).alias("feedback_id"),
        F.concat(F.lit("P"), F.col("user_id")).alias("patient_id"),
        F.col("ts").alias("timestamp"),
        F.lit("praise").alias("feedback_type"),
        F.lit("call").alias("feedback_mode"),
        F.lit("general").alias("department"),
        F.lit("East").alias("call_centre"),
        F.col("event_type").alias("comments"),
        score.alias("satisfaction_score"),
        score.alias("professionalism_score"),
        score.alias("response_time_score"),
        score.alias("resolution_score"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("overall_score"),
        F.lit("Yes").alias("resolution_provided"),
    )
    source, clean = scratch_path(spark, "feedback-files"), scratch_path(spark, "feedback")
    events.select(*FEEDBACK.names).write.option("header", True).csv(source)
    jobs.process_feedback(spark, source, clean, scratch_path(spark, "quarantine"))
    return jobs.load_feedback(spark, clean).select(
        "feedback_id", "overall_score", "satisfaction_score"
    )


@query(
    "parquet_by_name",
    "select o_orderkey, cast(o_custkey as varchar) as o_custkey, cast(null as date) as absent from orders",
)
def parquet_by_name(spark, sf_dir):
    """Columns are found by name whatever their case, cast, and null where the files lack them."""
    orders = d.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "upper-case")
    orders.select(*[F.col(c).alias(c.upper()) for c in orders.columns]).write.parquet(path)
    schema = T.StructType.fromDDL("o_orderkey long, o_custkey string, absent date")
    held = T.StructType.fromDDL("o_orderkey long, o_custkey long")
    return read_parquet_dir(spark, path, schema, held)


@query(
    "reloaded_table",
    "select o_orderkey as call_id, o_orderpriority as call_centre from orders",
)
def reloaded_table(spark, sf_dir):
    """Rows loaded by position into a catalog table that was truncated after a first load."""
    orders = d.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "by-position")
    name = "by_position_" + path.rsplit("-", 1)[-1]
    empty = empty_like(orders).select(
        F.col("o_orderkey").alias("call_id"), F.col("o_orderpriority").alias("call_centre")
    )
    empty.write.option("path", path).saveAsTable(name)
    load_by_position(orders, name, ["o_orderkey", "o_orderpriority"])
    truncate(spark, path)
    load_by_position(orders, name, ["o_orderkey", "o_orderpriority"])
    # The table lies outside the warehouse: dropping its entry leaves the rows.
    spark.sql(f"drop table {name}")
    return spark.read.parquet(path)


@query(
    "checked_in_one_pass",
    with_tables(
        "register",
        body=f"""
        , {copies_sql("orders", "o_orderkey")}
        select 'A' || format('{{:05d}}', counter) as id,
          case when o_orderstatus = 'P' then 'rejected' else 'valid' end as outcome,
          case when o_orderstatus = 'P' then 'status code' else '' end as errors from copies""",
    ),
)
def checked_in_one_pass(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "P", "lost").otherwise("booked")
    path = scratch_path(spark, "checked")
    write_checked(appointments(spark, sf_dir, status=status), RULES["Appointment"], path)
    return spark.read.parquet(path).select(
        "id", "outcome", F.array_join("errors", "; ").alias("errors")
    )


@query(
    "csv_inferred",
    "select cast(c_custkey as integer) as c_custkey, c_name, c_acctbal from customer",
)
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "inferred")
    customers = d.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    customers.write.option("header", True).csv(path)
    return read_csv_dir(spark, path)


@query(
    "validate_or_fail",
    with_tables(
        "register",
        body=f"""
        , {copies_sql("customer", "c_custkey")}
        select 'P' || "PracticeCode" || '-' || format('{{:02d}}', number) as id, c_name as family from copies""",
    ),
)
def validate_or_fail(spark, sf_dir):
    """Under the strict policy sound documents pass; one bad document would fail the job."""
    valid, _ = validate(patients(spark, sf_dir), RULES["Patient"], FAIL)
    return valid.select("id", F.get_json_object("resource_json", "$.name[0].family").alias("family"))


@query(
    "validate_none",
    with_tables(
        "register",
        body=f"""
        , {copies_sql("orders", "o_orderkey")}
        select 'A' || format('{{:05d}}', counter) as id, 'lost' as status from copies""",
    ),
)
def validate_none(spark, sf_dir):
    docs = appointments(spark, sf_dir, status=F.lit("lost"))
    passed, _ = validate(docs, RULES["Appointment"], NONE)
    return passed.select("id", F.get_json_object("resource_json", "$.status").alias("status"))


@query(
    "resources_end_to_end",
    with_tables(
        "register",
        body=f"""
        , {copies_sql("orders", "o_orderkey")}
        select "PracticeCode" || '-practitioner' || n as practitioner_id,
          case when n = 1 then 'Jo Family' || "PracticeCode" end as practitioner_name,
          count(*) as total_appointments
        from (select *, o_custkey % 10 + 1 as n from copies) group by all""",
    ),
)
def resources_end_to_end(spark, sf_dir):
    """Register to report: build, check and store two resource types, load them, join them.

    Only the first of each practice's ten practitioners has a document, so the other references
    dangle and keep a null name.
    """
    store = scratch_path(spark, "store")
    practices = d.practices(spark, sf_dir)
    day = F.lit("2024-01-01").cast("date")
    practitioner = {
        "active": F.lit(True), "family": F.concat(F.lit("Family"), F.col("PracticeCode")),
        "given": F.lit("Jo"), "prefix": F.lit("Dr."), "suffix": F.lit("MD"),
        "gender": F.lit("other"), "birth_date": day, "qualification": F.lit("MD"),
        "certificate": F.lit("QUAL-1"), "start": day, "end": day, "phone": F.lit("none"),
    }
    docs = build.build_practitioner(practices, practitioner, number=F.lit(1))
    valid, _ = validate(docs, RULES["Practitioner"], FAIL)
    write_resources(valid, store, "Practitioner")
    booked, _ = validate(appointments(spark, sf_dir), RULES["Appointment"])
    write_resources(booked, store, "Appointment")
    return reports.count_by_reference(
        jobs.load_resource(spark, store, "Appointment"),
        jobs.load_resource(spark, store, "Practitioner"),
    )


@query(
    "resources_rerun",
    with_tables(
        "practices",
        body="""
        select cast("PracticeCode" as varchar) as id, 1 as stored, 1 as done, 1 as processed from practices""",
    ),
)
def resources_rerun(spark, sf_dir):
    """The resource job and the merge of its rows, twice: one row per id in the store, the list of ids
    done and the processed table."""
    store, done = scratch_path(spark, "store"), scratch_path(spark, "done")
    inputs = {"family": F.lit("F"), "given": F.lit("G"), "phone": F.lit("none")}
    table = None
    for _ in range(2):
        jobs.produce_resources(d.practices(spark, sf_dir), "Organization", inputs, store, done)
        loaded = jobs.load_resource(spark, store, "Organization")
        if table is None:
            root = scratch_path(spark, "processed")
            table = jobs.create_processed({"organization": (loaded, ["id"])}, root)["organization"]
        jobs.refresh(table, loaded)

    def counted(rows, name):
        return rows.groupBy("id").agg(F.count("*").cast("int").alias(name))

    known = counted(spark.read.parquet(done), "done")
    return counted(loaded, "stored").join(known, "id").join(counted(table.read(), "processed"), "id")


@query(
    "feedback_quarantine",
    """
    select 'FB-' || event_id as feedback_id, value + 0.5 as overall_score, 'feedback' as dataset
    from events where event_type = 'error'""",
)
def feedback_quarantine(spark, sf_dir):
    """Feedback without comments is quarantined with its scores as they came."""
    events = d.table(spark, sf_dir, "events")
    known = {
        "feedback_id": F.concat(F.lit("FB-"), F.col("event_id")),
        "timestamp": F.col("ts"),
        "overall_score": F.col("value") + 0.5,
        "comments": F.when(F.col("event_type") != "error", F.col("event_type")),
    }
    filler = {f.name: F.lit("7" if f.name in FEEDBACK_SCORES else "x") for f in FEEDBACK}
    source, quarantine = scratch_path(spark, "feedback-files"), scratch_path(spark, "quarantine")
    rows = events.select(*[known.get(c, filler[c]).alias(c) for c in FEEDBACK.names])
    rows.write.option("header", True).csv(source)
    jobs.process_feedback(spark, source, scratch_path(spark, "feedback"), quarantine)
    return read_quarantine(spark, quarantine, QUARANTINE).select("feedback_id", "overall_score", "dataset")


@query(
    "missing_required_fields",
    with_tables(
        "register",
        body=f"""
        , {copies_sql("orders", "o_orderkey")}
        select 'A' || format('{{:05d}}', counter) as id, 'status required' as errors
        from copies where o_orderstatus = 'P'""",
    ),
)
def missing_required_fields(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") != "P", "booked")
    _, rejected = validate(appointments(spark, sf_dir, status=status), RULES["Appointment"])
    return rejected.select("id", F.array_join("errors", "; ").alias("errors"))


def _array_lines(spark, sf_dir) -> str:
    """Each customer as a line with an array of one document; those in debt break off in the middle."""
    whole = F.concat(F.lit('[{"resourceType": "Patient", "id": "C'), F.col("c_custkey"), F.lit('"}]'))
    customers = d.table(spark, sf_dir, "customer")
    line = F.when(F.col("c_acctbal") < 0, F.substring(whole, F.lit(1), F.length(whole) - 2)).otherwise(whole)
    store = scratch_path(spark, "arrays")
    customers.select(line.alias("value")).write.text(f"{store}/Patient")
    return store


_ARRAYS_SQL = """
    select 'C' || c_custkey as id, case when c_acctbal < 0 then 'rejected' else 'loaded' end as outcome
    from customer"""


def _array_outcomes(loaded, rejected):
    broken = F.regexp_extract("raw_data", "(C[0-9]+)", 1).alias("id")
    return loaded.select("id", F.lit("loaded").alias("outcome")).unionByName(
        rejected.select(broken, F.lit("rejected").alias("outcome"))
    )


@query("rejected_arrays", _ARRAYS_SQL)
def rejected_arrays(spark, sf_dir):
    rejects = scratch_path(spark, "array-rejects")
    loaded = jobs.load_good_resources(spark, _array_lines(spark, sf_dir), "Patient", rejects)
    return _array_outcomes(loaded, spark.read.parquet(rejects))


@query("rejected_arrays_stream", _ARRAYS_SQL)
def rejected_arrays_stream(spark, sf_dir):
    path, rejects = scratch_path(spark, "array-rows"), scratch_path(spark, "array-rejects")
    docs = document_stream(spark, f"{_array_lines(spark, sf_dir)}/Patient")
    load_resource_stream(
        docs, specs.PATIENT, path, scratch_path(spark, "array-progress"), rejects
    ).awaitTermination()
    return _array_outcomes(spark.read.parquet(path), spark.read.parquet(rejects))


@query(
    "corrupt_files_noted",
    """
    select 'orders-unreadable' as table_name, cast(1 as bigint) as reject_count,
      (select count(*) from orders) as loaded""",
)
def corrupt_files_noted(spark, sf_dir):
    """A folder with a file that is not Parquet: the others are loaded, and it is noted."""
    path, audit = scratch_path(spark, "partly-broken"), scratch_path(spark, "audit")
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey")
    orders.write.parquet(path)
    orders.limit(1).select(F.lit("broken").alias("value")).write.mode("append").text(path)
    rows = read_parquet_dir(spark, path, orders.schema, glob="part-*", skip_corrupt=True)
    note_unreadable(unreadable_files(spark, path, rows, glob="part-*"), audit, "orders")
    loaded = rows.agg(F.count("*")).scalar()
    return load_audit(spark, audit).select("table_name", "reject_count", loaded.alias("loaded"))


def _half_broken(spark, good: str, path: str) -> None:
    """Copies of Parquet files with some bytes of their middle overwritten.

    The format's last four bytes are written as the end of the text writer's only line.
    """
    content, size = F.col("content"), F.col("length").cast("int")
    begin = (size * 3 / 5).cast("int")
    kept = F.substring(content, F.lit(1), begin)
    rest = F.substring(content, begin + 1 + 400, size - begin - 400 - 4)
    text = F.concat(kept.cast("string"), F.repeat(F.lit("#"), F.lit(400)), rest.cast("string"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.parquet").load(good)
    files.select(text.alias("value")).write.option("lineSep", "PAR1").text(path)


@query(
    "load_history",
    """
    select * from (
      select 'good' as part, 2 as notes, 'loaded' as status, count(*) filter (o_orderkey % 3 = 0) as rows_expected, true as agrees from orders
      union all
      select 'half', 2, 'partly loaded', count(*) filter (o_orderkey % 3 = 1), true from orders
      union all
      select 'none', 2, 'failed', null, true
      union all
      select 'void', 2, 'loaded', 0, true)""",
)
def load_history(spark, sf_dir):
    """A good file, one broken in its middle, one that is no Parquet file and one without rows, loaded twice."""
    root, notes = scratch_path(spark, "partly-broken"), scratch_path(spark, "history")
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    small = {"parquet.block.row.count.limit": "100", "compression": "none"}
    parts = {"good": orders.filter("o_orderkey % 3 = 0"), "void": orders.filter("false"), "whole": orders.filter("o_orderkey % 3 = 1")}
    for name, rows in parts.items():
        folder = f"{root}/{name}" if name != "whole" else scratch_path(spark, "whole")
        rows.coalesce(1).write.options(**small).parquet(folder)
        if name == "whole":
            _half_broken(spark, folder, f"{root}/half")
    orders.limit(1).select(F.lit("no table").alias("value")).write.text(f"{root}/none")
    loads = [history.load_files(spark, root, orders.schema, notes, "orders", glob="part-*") for _ in range(2)]
    loaded = loads[0].agg(F.count("*")).scalar()
    noted = history.load_history(spark, notes, "orders")
    part = F.regexp_extract("file_name", "/(good|half|none|void)/", 1).alias("part")
    # Both runs read the same rows, which are those that the load returned, and the broken file lost some but not all.
    by_run = noted.groupBy("run_id").agg(F.sum("rows_read").alias("all_read"))
    lost = F.col("rows_expected") - F.col("rows_read")
    sound = F.when(F.col("status") == "partly loaded", (lost > 0) & (F.col("rows_read") > 0)).otherwise(F.coalesce(lost, F.lit(0)) == 0)
    return noted.join(by_run, "run_id").groupBy(part, "status", "rows_expected").agg(
        F.count("*").cast("int").alias("notes"), F.every(sound & (F.col("all_read") == loaded)).alias("agrees")
    )


@query("staged_load_times", "select count(*) as documents, true as just_now from customer")
def staged_load_times(spark, sf_dir):
    """Every staged document carries the time it was loaded."""
    customers, store = d.table(spark, sf_dir, "customer"), scratch_path(spark, "store")
    write_resources(customers.select(F.to_json(F.struct("c_custkey", "c_name")).alias("resource_json")), store, "Person")
    began = spark.sql("select current_timestamp() as began").first()["began"]
    fresh = F.col("load_timestamp").between(F.lit(began), F.current_timestamp())
    docs = materialize(read_resource(spark, store, "Person"), "staged")
    return docs.agg(F.count("*").alias("documents"), F.every(fresh).alias("just_now"))


@query(
    "empty_input_refused",
    """
    select 'all' as selection, count(*) = 0 as refused from customer
    union all select 'rich', count(*) = 0 from customer where c_acctbal > 1e9""",
)
def empty_input_refused(spark, sf_dir):
    """A job refuses a selection without rows, and takes one with rows."""
    customers, refused = d.table(spark, sf_dir, "customer"), []
    for name, rows in {"all": customers, "rich": customers.filter("c_acctbal > 1e9")}.items():
        try:
            require_rows(rows, name)
        except ValueError as error:
            refused += [name] if name in str(error) else []
    named = customers.limit(1).select(F.explode(F.array(F.lit("all"), F.lit("rich"))).alias("selection"))
    return named.withColumn("refused", F.col("selection").isin(refused))


@query(
    "processed_calls",
    with_tables(
        "calls",
        body="""
        select call_id, call_centre, resolution_status,
          case when resolution_status = 'resolved' then call_duration + 100 else call_duration end as call_duration
        from calls where resolution_status <> 'pending'
        union all select 'N' || call_id, call_centre, 'new', call_duration from calls where call_duration = 7""",
    ),
)
def processed_calls(spark, sf_dir):
    """Calls in their processed table after a batch that updates, deletes and adds some."""
    calls = d.calls(spark, sf_dir).select("call_id", "call_centre", "resolution_status", "call_duration")
    table = ProcessedTable.create(calls, scratch_path(spark, "processed-calls"), ["call_id"])
    jobs.refresh(table, calls)
    status = F.col("resolution_status")
    known = calls.filter(status.isin("resolved", "pending")).withColumn("action", F.when(status == "pending", "DELETE").otherwise("UPDATE"))
    known = known.withColumn("call_duration", F.col("call_duration") + 100)
    new = calls.filter("call_duration = 7").withColumn("call_id", F.concat(F.lit("N"), "call_id"))
    new = new.withColumn("resolution_status", F.lit("new")).withColumn("action", F.lit("INSERT"))
    table.apply(known.unionByName(new))
    return table.read()
