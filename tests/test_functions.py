from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wardflow.functions import numbers, text, times


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("column", "expected"),
    [
        (lambda: text.squashed(F.lit("West Practice, X")), "westpractice,x"),
        (lambda: text.slug(F.lit("West-Practice, X_1")), "westpracticex1"),
        (lambda: text.slug(F.lit("West-Practice, X_1"), keep_dash=True), "west-practicex1"),
        (lambda: text.last_segment(F.lit("Patient/P1-01")), "P1-01"),
        (lambda: text.last_segment(F.lit("plain")), "plain"),
        (lambda: text.last_segment(F.lit("Patient/")), None),
        (lambda: text.last_segment(F.lit(None).cast("string")), None),
        (lambda: text.present_parts(F.lit("a"), F.lit(""), F.lit(None).cast("string"), F.lit("b")), ["a", "b"]),
        (lambda: text.first_present(F.lit(""), F.lit("b")), "b"),
        (lambda: text.first_present(F.lit(None).cast("string"), F.lit("b")), "b"),
        (lambda: text.first_present(F.lit("a"), F.lit("b")), "a"),
        (lambda: text.default_to(F.lit(None).cast("string"), "x"), "x"),
        (lambda: text.capitalized(F.lit("entered-in-ERROR")), "Entered-in-error"),
        (lambda: text.capitalized(F.lit("")), ""),
        (lambda: text.padded_id("CL-", F.lit(7), 3), "CL-007"),
        (lambda: text.padded_id("CL-", F.lit(12345), 3), "CL-12345"),
        (lambda: text.patient_key(F.lit(10002), F.lit(100)), "P10002-100"),
        (lambda: text.patient_key(F.lit(10002), F.lit(1)), "P10002-01"),
        (lambda: text.practitioner_key(F.lit(10002)), "10002-practitioner"),
        (lambda: text.practitioner_key(F.lit(10002), F.lit(3)), "10002-practitioner3"),
        (lambda: text.lookup(F.lit("b"), {"a": "A", "b": "B"}), "B"),
        (lambda: text.lookup(F.lit("z"), {"a": "A", "b": "B"}), None),
        (lambda: numbers.wrapped(F.lit(100)), 100),
        (lambda: numbers.wrapped(F.lit(101)), 1),
        (lambda: numbers.row_mean([F.lit(5), F.lit(6), F.lit(7), F.lit(8)]), 6.5),
        (lambda: times.day_text(F.lit("2024-02-03 04:05:06").cast("timestamp")), "2024-02-03"),
        (lambda: times.second_text(F.lit("2024-02-03 04:05:06").cast("timestamp")), "2024-02-03 04:05:06"),
        (lambda: times.iso_text(F.lit("2024-02-03 04:05:06.5").cast("timestamp")), "2024-02-03T04:05:06.500000+00:00"),
        (lambda: times.shifted(F.lit("2024-02-28 23:45:00").cast("timestamp"), 1, 30).cast("string"), "2024-03-01 00:15:00"),
        (lambda: (F.current_timestamp() - times.hours_ago(24)) == F.expr("INTERVAL 24 HOURS"), True),
    ],
)
def test_function(spark, column, expected):
    assert one(spark, column()) == expected
