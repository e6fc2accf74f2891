"""The operational reports.

Each report reduces the large side to one row per key before it joins, so a busy centre,
practitioner or patient is added up in the map tasks and never collected into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def busiest_group(calls: DataFrame, group: str = "call_centre", total: str = "total_calls") -> DataFrame:
    """The group with most rows; equal counts are decided by the group's name."""
    counted = calls.groupBy(group).agg(F.count("*").alias(total))
    return counted.orderBy(F.desc(total), F.asc(group)).limit(1)


def count_by_reference(
    child: DataFrame,
    parent: DataFrame,
    reference: str = "practitioner_id",
    key: str = "id",
    label: str = "practitioner_name",
    total: str = "total_appointments",
    how: str = "left",
) -> DataFrame:
    """Rows of ``child`` per reference and parent label, most first.

    The result is that of joining row by row and grouping by both columns, also when several
    parents share a key: counts multiply instead of rows.
    """
    held = child.groupBy(reference).agg(F.count("*").alias("_held"))
    named = parent.groupBy(F.col(key).alias(reference), label).agg(F.count("*").alias("_parents"))
    matched = held.join(named, reference, how)
    counted = matched.select(
        reference, label, (F.col("_held") * F.coalesce("_parents", F.lit(1))).alias(total)
    )
    return counted.orderBy(F.desc(total), F.asc_nulls_last(reference), F.asc_nulls_last(label))


def avg_by_group(
    calls: DataFrame,
    group: str = "call_centre",
    score: str = "satisfaction_score",
    mean: str = "avg_satisfaction_score",
) -> DataFrame:
    """Mean score per group, best first; groups without any score come last."""
    averaged = calls.groupBy(group).agg(F.avg(score).alias(mean))
    return averaged.orderBy(F.desc_nulls_last(mean), F.asc(group))


def frequent_patients(
    patients: DataFrame,
    calls: DataFrame,
    min_calls: int = 10,
    score: str = "satisfaction_score",
    name: str = "patient_name",
) -> DataFrame:
    """Patients with more than ``min_calls`` scored calls, by mean score.

    Grouped by name, so patients of equal name count as one. Calls are summed per patient id
    first; the sums, not the calls, meet the patients.
    """
    per_patient = (
        calls.filter(F.col(score).isNotNull())
        .groupBy(F.col("patient_id").alias("id"))
        .agg(
            F.sum(score).alias("_score"),
            F.count(score).alias("_scored"),
            F.count("call_id").alias("_calls"),
        )
    )
    per_name = (
        patients.select("id", name)
        .join(per_patient, "id")
        .groupBy(name)
        .agg(
            F.sum("_score").alias("_score"),
            F.sum("_scored").alias("_scored"),
            F.sum("_calls").alias("total_calls"),
        )
    )
    return (
        per_name.filter(F.col("total_calls") > min_calls)
        .select(
            name,
            (F.col("_score") / F.col("_scored")).alias("average_satisfaction_score"),
            "total_calls",
        )
        .orderBy(F.desc("average_satisfaction_score"), F.desc("total_calls"), F.asc(name))
    )
