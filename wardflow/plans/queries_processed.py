"""Every data set's processed table under arriving changes.

Documents arrive as files named by what happened to them; each is flattened into its table's columns
and merged. First everything is inserted. Then, by the last digit of their id, some documents come
again with one field changed, some are deleted, and some are inserted a second time, which does nothing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.documents import build, specs
from wardflow.documents.flatten import flatten
from wardflow.plans import standins as d
from wardflow.plans.catalog import query
from wardflow.plans.queries_documents import (
    BODY,
    appointments,
    conditions,
    copies,
    copies_sql,
    endpoint_inputs,
    patients,
    practice_inputs,
    practitioner_inputs,
)
from wardflow.plans.standins import with_tables
from wardflow.session import materialize, scratch_path
from wardflow.streaming.ingest import ONCE, document_stream, file_stream
from wardflow.streaming.upsert import ProcessedTable, merge_stream

_LAST = "right(regexp_replace({id}, '[^0-9]', '', 'g'), 1)"
UPDATED, DELETED = ("1", "4", "7"), ("2", "8")
#: Documents a file holds at most, or copies that as many are built of. Both take little room for the work they
#: make, and one task reads a compressed file, however large it is.
DOCUMENTS_PER_FILE = 50_000


def _last_digit(name: str):
    return F.right(F.regexp_replace(name, "[^0-9]", ""), F.lit(1))


def _made_once(spark, sf_dir, name: str, key: str):
    """The numbered copies, written: documents are built of them four times."""
    return materialize(copies(spark, sf_dir, name, key), "copies", rows_per_file=DOCUMENTS_PER_FILE)


def _merged(spark, docs, changed, spec, key: str, columns: list[str]):
    """The processed table after both rounds of arriving documents."""
    root, progress = scratch_path(spark, "arriving"), scratch_path(spark, "arriving-progress")

    def arrive(rows, action: str) -> None:
        lines = rows.select(F.col(BODY).alias("value")).write.mode("append")
        lines = lines.option("maxRecordsPerFile", DOCUMENTS_PER_FILE)
        lines.text(f"{root}/action={action}", compression="gzip")

    table = None
    for step in range(2):
        if step == 0:
            arrive(docs, "INSERT")
        else:
            last = _last_digit("id")
            arrive(changed.filter(last.isin(*UPDATED)), "UPDATE")
            arrive(docs.filter(last.isin(*DELETED)), "DELETE")
            arrive(changed.filter(~last.isin(*UPDATED, *DELETED)), "INSERT")
        staged = document_stream(spark, f"{root}/action=*")
        action = F.regexp_extract("folder_name", "action=([A-Z]+)/", 1).alias("action")
        rows = flatten(staged.select("raw_data", action), spec, keep=["action"])
        if table is None:
            like = flatten(docs, spec, body=BODY)
            table = ProcessedTable.create(like, scratch_path(spark, "processed"), [key], buckets=4)
        merge_stream(rows, table, progress, trigger=ONCE).awaitTermination()
    return table.read().select(*columns)


def _merged_sql(base: str, key: str, changed: str, new: str, others: str) -> str:
    """``base`` after the changes; ``new`` is the changed column's value in updated rows."""
    last = _LAST.format(id=key)
    return f"""
        select {key}, case when {last} in {UPDATED} then {new} else {changed} end as {changed}, {others}
        from ({base}) where {last} not in {DELETED}"""


def _over_practices(*parts: str) -> str:
    return with_tables("practices", body=_merged_sql(*parts))


def _over_copies(name: str, key: str, *parts: str) -> str:
    return with_tables("register", body=f", {copies_sql(name, key)} {_merged_sql(*parts)}")


@query(
    "processed_organization",
    _over_practices(
        """select cast("PracticeCode" as varchar) as id, "GPPracticeName" as organization_name,
            "GPCluster" as state from practices""",
        "id", "organization_name", "organization_name || ' new'", "state",
    ),
)
def processed_organization(spark, sf_dir):
    practices = d.practices(spark, sf_dir)
    renamed = practices.withColumn("GPPracticeName", F.concat("GPPracticeName", F.lit(" new")))
    docs, changed = [build.build_organization(p, practice_inputs(False)) for p in (practices, renamed)]
    columns = ["id", "organization_name", "state"]
    return _merged(spark, docs, changed, specs.ORGANIZATION, "id", columns)


@query(
    "processed_endpoint",
    _over_practices(
        """select regexp_replace(lower("GPPracticeName"), '[^a-z0-9]', '', 'g') as id,
            date '2024-06-30' + cast("PracticeCode" % 500 as integer) as end_date,
            cast("PracticeCode" as varchar) as practice_code from practices""",
        "id", "end_date", "date '2031-01-01'", "practice_code",
    ),
)
def processed_endpoint(spark, sf_dir):
    practices = d.practices(spark, sf_dir)
    later = {**endpoint_inputs(), "end": F.lit("2031-01-01").cast("date")}
    docs, changed = [build.build_endpoint(practices, given) for given in (endpoint_inputs(), later)]
    columns = ["id", "end_date", "practice_code"]
    return _merged(spark, docs, changed, specs.ENDPOINT, "id", columns)


@query(
    "processed_practitioner",
    _over_practices(
        """select "PracticeCode" || '-practitioner' as id,
            'QUAL-' || ("PracticeCode" + 10000) as certification_number,
            ['male', 'female', 'other', 'unknown']["PracticeCode" % 4 + 1] as gender from practices""",
        "id", "certification_number", "'QUAL-0'", "gender",
    ),
)
def processed_practitioner(spark, sf_dir):
    practices = d.practices(spark, sf_dir)
    given = practitioner_inputs()
    renewed = {**given, "certificate": F.lit("QUAL-0")}
    docs, changed = [build.build_practitioner(practices, g) for g in (given, renewed)]
    columns = ["id", "certification_number", "gender"]
    return _merged(spark, docs, changed, specs.PRACTITIONER, "id", columns)


@query(
    "processed_patient",
    _over_copies(
        "customer", "c_custkey",
        """select 'P' || "PracticeCode" || '-' || format('{:02d}', number) as id,
            lower(c_mktsegment) || '.' || c_custkey || '@gmail.com' as email,
            '555-' || c_custkey as phone_number from copies""",
        "id", "email", "'moved@example.org'", "phone_number",
    ),
)
def processed_patient(spark, sf_dir):
    rows = _made_once(spark, sf_dir, "customer", "c_custkey")
    docs, changed = patients(spark, sf_dir, rows), patients(spark, sf_dir, rows, email=F.lit("moved@example.org"))
    columns = ["id", "email", "phone_number"]
    return _merged(spark, docs, changed, specs.PATIENT, "id", columns)


@query(
    "processed_appointment",
    _over_copies(
        "orders", "o_orderkey",
        """select 'A' || format('{:05d}', counter) as id, 'About ' || o_orderpriority as description,
            cast(30 as integer) as "minutesDuration" from copies""",
        "id", "description", "'Moved'", '"minutesDuration"',
    ),
)
def processed_appointment(spark, sf_dir):
    rows = _made_once(spark, sf_dir, "orders", "o_orderkey")
    docs, changed = appointments(spark, sf_dir, rows), appointments(spark, sf_dir, rows, description=F.lit("Moved"))
    columns = ["id", "description", "minutesDuration"]
    return _merged(spark, docs, changed, specs.APPOINTMENT, "id", columns)


@query(
    "processed_condition",
    _over_copies(
        "events", "event_id",
        """select 'C' || format('{:05d}', counter) as id,
            ['unconfirmed', 'provisional', 'differential', 'confirmed', 'refuted', 'entered-in-error']
              [event_id % 6 + 1] as verification_status,
            ['active', 'recurrence', 'relapse', 'inactive', 'remission', 'resolved'][event_id % 6 + 1]
              as clinical_status from copies""",
        "id", "verification_status", "'confirmed'", "clinical_status",
    ),
)
def processed_condition(spark, sf_dir):
    rows = _made_once(spark, sf_dir, "events", "event_id")
    docs, changed = conditions(spark, sf_dir, rows), conditions(spark, sf_dir, rows, verification=F.lit("confirmed"))
    columns = ["id", "verification_status", "clinical_status"]
    return _merged(spark, docs, changed, specs.CONDITION, "id", columns)


@query(
    "processed_feedback",
    _merged_sql(
        "select 'FB-' || event_id as feedback_id, value as overall_score, event_type as feedback_type from events",
        "feedback_id", "overall_score", "overall_score + 1", "feedback_type",
    ),
)
def processed_feedback(spark, sf_dir):
    """Feedback rows come as changes already, in one stream of Parquet files."""
    events = d.table(spark, sf_dir, "events")
    rows = events.select(
        F.concat(F.lit("FB-"), F.col("event_id")).alias("feedback_id"),
        F.col("value").alias("overall_score"),
        F.col("event_type").alias("feedback_type"),
    )
    last = _last_digit("feedback_id")
    raised = rows.withColumn("overall_score", F.col("overall_score") + 1)
    action = F.when(last.isin(*UPDATED), "UPDATE").when(last.isin(*DELETED), "DELETE").otherwise("INSERT")
    path, progress = scratch_path(spark, "feedback-changes"), scratch_path(spark, "feedback-progress")
    table = ProcessedTable.create(rows, scratch_path(spark, "processed"), ["feedback_id"], buckets=4)
    for changes in (rows.withColumn("action", F.lit("INSERT")), raised.withColumn("action", action)):
        changes.write.mode("append").parquet(path)
        stream = file_stream(spark, path, changes.schema).drop("file_name")
        merge_stream(stream, table, progress, trigger=ONCE).awaitTermination()
    return table.read()
