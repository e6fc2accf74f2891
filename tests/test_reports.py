from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.plans import reports


def test_busiest_group_breaks_ties_by_name(spark):
    calls = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "call_centre string")
    assert [tuple(r) for r in reports.busiest_group(calls).collect()] == [("a", 2)]


def joined_rowwise(child, parent, how):
    joined = child.join(parent, child.practitioner_id == parent.id, how)
    return joined.groupBy("practitioner_id", "practitioner_name").agg(
        F.count("*").alias("total_appointments")
    )


def test_counts_equal_those_of_the_rowwise_join(spark):
    child = spark.createDataFrame(
        [("p1",)] * 3 + [("p2",)] * 2 + [("p3",), (None,), (None,)], "practitioner_id string"
    )
    parent = spark.createDataFrame(
        [("p1", "A"), ("p1", "A"), ("p1", "B"), ("p2", None), (None, "N")],
        "id string, practitioner_name string",
    )
    for how in ("left", "inner"):
        found = reports.count_by_reference(child, parent, how=how)
        expected = joined_rowwise(child, parent, how)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(
            map(tuple, expected.collect()), key=str
        )
        counts = [r.total_appointments for r in found.collect()]
        assert counts == sorted(counts, reverse=True)


def test_mean_skips_missing_scores_and_puts_unscored_groups_last(spark):
    calls = spark.createDataFrame(
        [("a", 1), ("a", None), ("b", 4), ("c", None)], "call_centre string, satisfaction_score int"
    )
    found = [tuple(r) for r in reports.avg_by_group(calls).collect()]
    assert found == [("b", 4.0), ("a", 1.0), ("c", None)]


def test_frequent_patients_merge_equal_names_and_count_scored_calls(spark):
    patients = spark.createDataFrame(
        [("1", "Jo"), ("2", "Jo"), ("3", "Al"), ("3", "Al"), ("4", "Bo")], "id string, patient_name string"
    )
    calls = (
        [("1", 5)] * 6 + [("2", 3)] * 5 + [("3", 4)] * 6 + [("4", 1)] * 10 + [("4", None)] * 5 + [("9", 1)] * 20
    )
    calls = spark.createDataFrame(
        [(f"c{i}", p, s) for i, (p, s) in enumerate(calls)],
        "call_id string, patient_id string, satisfaction_score int",
    )
    found = [tuple(r) for r in reports.frequent_patients(patients, calls).collect()]
    # Two rows of patient 3 double that patient's calls, as the row-wise join does.
    assert found == [("Jo", 45 / 11, 11), ("Al", 4.0, 12)]


def test_calls_are_reduced_before_the_join(spark):
    patients = spark.createDataFrame([("1", "Jo")], "id string, patient_name string")
    calls = spark.range(100).selectExpr("id as call_id", "string(id % 3) as patient_id", "1 as satisfaction_score")
    plan = reports.frequent_patients(patients, calls)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert plan.index("Aggregate [patient_id", join) > join, plan
