"""Declared schemas. Column names, order and types of the shared data model."""

from __future__ import annotations

from pyspark.sql import types as T

CALLS = T.StructType(
    [
        T.StructField("call_id", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("call_type", T.StringType()),
        T.StructField("resolution_status", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("call_duration", T.IntegerType()),
        T.StructField("notes", T.StringType()),
        T.StructField("follow_up_required", T.StringType()),
        T.StructField("satisfaction_score", T.IntegerType()),
        T.StructField("call_centre", T.StringType()),
    ]
)

FEEDBACK = T.StructType(
    [
        T.StructField("feedback_id", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("feedback_type", T.StringType()),
        T.StructField("feedback_mode", T.StringType()),
        T.StructField("department", T.StringType()),
        T.StructField("call_centre", T.StringType()),
        T.StructField("comments", T.StringType()),
        T.StructField("satisfaction_score", T.IntegerType()),
        T.StructField("professionalism_score", T.IntegerType()),
        T.StructField("response_time_score", T.IntegerType()),
        T.StructField("resolution_score", T.IntegerType()),
        T.StructField("overall_score", T.DoubleType()),
        T.StructField("resolution_provided", T.StringType()),
    ]
)

FEEDBACK_SCORES = (
    "overall_score",
    "satisfaction_score",
    "professionalism_score",
    "response_time_score",
    "resolution_score",
)

# Fields of the practice register that the document builders use.
PRACTICE = T.StructType(
    [
        T.StructField("PracticeCode", T.LongType()),
        T.StructField("GPPracticeName", T.StringType()),
        T.StructField("AddressLine1", T.StringType()),
        T.StructField("AddressLine2", T.StringType()),
        T.StructField("AddressLine3", T.StringType()),
        T.StructField("AddressLine4", T.StringType()),
        T.StructField("GPCluster", T.StringType()),
        T.StructField("Postcode", T.StringType()),
        T.StructField("TelephoneNumber", T.StringType()),
    ]
)

# One landed page of the register service.
PAGE_ENVELOPE = T.StructType(
    [T.StructField("result", T.StructType([T.StructField("records", T.ArrayType(PRACTICE))]))]
)

# The cleaned feedback table keeps overall_score as a whole number.
FEEDBACK_TABLE = T.StructType(
    [
        T.StructField(f.name, T.IntegerType() if f.name == "overall_score" else f.dataType)
        for f in FEEDBACK
    ]
)

# Incomplete rows of both data sets in one place; a column is null where a data set lacks it.
QUARANTINE = T.StructType(
    [
        *CALLS.fields,
        *[f for f in FEEDBACK.fields if f.name not in CALLS.names],
        T.StructField("dataset", T.StringType()),
    ]
)
