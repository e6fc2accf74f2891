"""Reports over calls, appointments and patients."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.operators.keys import orphans
from wardflow.plans import reports
from wardflow.plans import standins as d
from wardflow.plans.catalog import query
from wardflow.plans.standins import with_tables


@query(
    "busiest_group",
    with_tables(
        "calls",
        body="""
        select call_centre, count(*) as total_calls from calls
        group by call_centre order by total_calls desc, call_centre limit 1""",
    ),
)
def busiest_group(spark, sf_dir):
    return reports.busiest_group(d.calls(spark, sf_dir))


_COUNTS = """
    select a.practitioner_id, p.practitioner_name, count(*) as total_appointments
    from appointments a {how} join practitioners p on a.practitioner_id = p.id
    group by a.practitioner_id, p.practitioner_name"""


@query(
    "left_join_counts",
    with_tables("appointments", "practitioners", body=_COUNTS.format(how="left")),
)
def left_join_counts(spark, sf_dir):
    return reports.count_by_reference(d.appointments(spark, sf_dir), d.practitioners(spark, sf_dir))


@query(
    "inner_join_counts",
    with_tables("appointments", "practitioners", body=_COUNTS.format(how="inner")),
)
def inner_join_counts(spark, sf_dir):
    return reports.count_by_reference(
        d.appointments(spark, sf_dir), d.practitioners(spark, sf_dir), how="inner"
    )


@query(
    "orphan_references",
    with_tables(
        "appointments",
        "practitioners",
        body="""
        select practitioner_id, count(*) as child_rows from appointments
        where practitioner_id not in (select id from practitioners)
        group by practitioner_id""",
    ),
)
def orphan_references(spark, sf_dir):
    return orphans(
        d.appointments(spark, sf_dir), "practitioner_id", d.practitioners(spark, sf_dir), "id"
    )


@query(
    "avg_satisfaction",
    with_tables(
        "calls",
        body="""
        select call_centre, avg(satisfaction_score) as avg_satisfaction_score
        from calls group by call_centre""",
    ),
)
def avg_satisfaction(spark, sf_dir):
    return reports.avg_by_group(d.calls(spark, sf_dir))


@query(
    "avg_score_by_group",
    """
    select o_orderpriority, round(avg(o_totalprice), 4) as avg_score
    from orders group by o_orderpriority""",
)
def avg_score_by_group(spark, sf_dir):
    averaged = reports.avg_by_group(
        d.table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", "avg_score"
    )
    return averaged.withColumn("avg_score", F.round("avg_score", 4))


@query(
    "frequent_patients",
    with_tables(
        "calls",
        "patients",
        body="""
        select p.patient_name, avg(c.satisfaction_score) as average_satisfaction_score,
          count(c.call_id) as total_calls
        from patients p join calls c on p.id = c.patient_id
        where c.satisfaction_score is not null
        group by p.patient_name having count(c.call_id) > 10""",
    ),
)
def frequent_patients(spark, sf_dir):
    return reports.frequent_patients(d.patients(spark, sf_dir), d.calls(spark, sf_dir))


@query(
    "calls_by_centre_and_status",
    with_tables(
        "calls",
        body="""
        select call_centre, resolution_status, count(*) as call_rows,
          count(satisfaction_score) as scored_rows
        from calls group by call_centre, resolution_status having count(*) > 10""",
    ),
)
def calls_by_centre_and_status(spark, sf_dir):
    counted = (
        d.calls(spark, sf_dir)
        .groupBy("call_centre", "resolution_status")
        .agg(
            F.count("*").alias("call_rows"), F.count("satisfaction_score").alias("scored_rows")
        )
        .filter(F.col("call_rows") > 10)
    )
    return counted.orderBy(F.desc("call_rows"), F.desc("scored_rows"))
