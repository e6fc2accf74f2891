"""The pipeline's data sets, derived from the star-schema test tables.

Each data set exists twice: as a DataFrame here and as SQL text in ``SQL``, a common table
expression the check queries start from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.text import padded_id, text_literal
from wardflow.operators.ordinals import with_ordinal
from wardflow.session import pin_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def pick(options: tuple[str, ...], index: Column) -> Column:
    """The option at a number, counting round."""
    listed = F.expr("array(" + ", ".join(text_literal(o) for o in options) + ")")
    return F.get(listed, F.pmod(index, F.lit(len(options))).cast("int"))


def sql_list(options: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{o}'" for o in options) + "]"


def sql_pick(options: tuple[str, ...], index: str) -> str:
    return f"{sql_list(options)}[({index}) % {len(options)} + 1]"


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as calls; pending calls have no score yet."""
    orders = table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return orders.select(
        padded_id("CL-", "o_orderkey", 3).alias("call_id"),
        F.concat(F.lit("P"), F.col("o_custkey")).alias("patient_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_orderpriority").alias("call_centre"),
        F.when(F.col("o_orderstatus") == "F", "resolved")
        .when(F.col("o_orderstatus") == "O", "unresolved")
        .otherwise("pending")
        .alias("resolution_status"),
        (cents % 60 + 1).cast("int").alias("call_duration"),
        F.when(F.col("o_orderstatus") != "P", cents % 5 + 1).cast("int").alias("satisfaction_score"),
    )


def gappy_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls as they arrive: unspecified centres are null, and so are the scores of pending calls."""
    return calls(spark, sf_dir).withColumn(
        "call_centre", F.nullif("call_centre", F.lit("4-NOT SPECIFIED"))
    )


def gappy_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feedback; errors come without a score."""
    return table(spark, sf_dir, "events").select(
        padded_id("FB-", "event_id", 5).alias("feedback_id"),
        F.concat(F.lit("P"), F.col("user_id")).alias("patient_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("feedback_type"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("overall_score"),
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("P"), F.col("c_custkey")).alias("id"), F.col("c_name").alias("patient_name")
    )


def appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as appointments with the practitioner who supplied them."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.col("l_suppkey"), F.lit("-practitioner")).alias("practitioner_id")
    )


def practitioners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in credit; the references to those in debt dangle."""
    return (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_acctbal") >= 1000)
        .select(
            F.concat(F.col("s_suppkey"), F.lit("-practitioner")).alias("id"),
            F.col("s_name").alias("practitioner_name"),
        )
    )


def practices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with their nation and region as the practice register."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return joined.select(
        F.col("s_suppkey").alias("PracticeCode"),
        F.concat("s_name", F.lit(" "), "n_name", F.lit(", "), "r_name").alias("GPPracticeName"),
        F.col("s_name").alias("AddressLine1"),
        F.when(F.col("s_acctbal") < 0, "").otherwise(F.col("n_name")).alias("AddressLine2"),
        F.col("r_name").alias("AddressLine3"),
        F.when(F.col("s_acctbal") > 5000, F.col("n_name"))
        .when(F.col("s_acctbal") > 2500, "")
        .alias("AddressLine4"),
        F.col("r_name").alias("GPCluster"),
        F.concat(F.lit("PC"), F.col("s_nationkey")).alias("Postcode"),
        F.when(F.col("n_regionkey") != 0, F.concat(F.lit("01382 "), F.col("s_suppkey"))).alias(
            "TelephoneNumber"
        ),
    )


def register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The practices with their place in the register."""
    return with_ordinal(practices(spark, sf_dir), ["PracticeCode"])


_CENTS = "cast(round(o_totalprice * 100) as bigint)"

SQL: dict[str, str] = {
    "calls": f"""
        select 'CL-' || format('{{:03d}}', o_orderkey) as call_id, 'P' || o_custkey as patient_id,
          o_orderdate as timestamp, o_orderpriority as call_centre,
          case o_orderstatus when 'F' then 'resolved' when 'O' then 'unresolved'
            else 'pending' end as resolution_status,
          cast({_CENTS} % 60 + 1 as integer) as call_duration,
          cast(case when o_orderstatus <> 'P' then {_CENTS} % 5 + 1 end as integer)
            as satisfaction_score
        from orders""",
    "gappy_calls": "select * replace (nullif(call_centre, '4-NOT SPECIFIED') as call_centre) from calls",
    "gappy_feedback": """
        select 'FB-' || format('{:05d}', event_id) as feedback_id, 'P' || user_id as patient_id,
          ts as timestamp, event_type as feedback_type,
          case when event_type <> 'error' then value end as overall_score
        from events""",
    "patients": "select 'P' || c_custkey as id, c_name as patient_name from customer",
    "appointments": "select l_suppkey || '-practitioner' as practitioner_id from lineitem",
    "practitioners": """
        select s_suppkey || '-practitioner' as id, s_name as practitioner_name
        from supplier where s_acctbal >= 1000""",
    "practices": """
        select s_suppkey as "PracticeCode", s_name || ' ' || n_name || ', ' || r_name as "GPPracticeName",
          s_name as "AddressLine1", case when s_acctbal < 0 then '' else n_name end as "AddressLine2",
          r_name as "AddressLine3",
          case when s_acctbal > 5000 then n_name when s_acctbal > 2500 then '' end as "AddressLine4",
          r_name as "GPCluster", 'PC' || s_nationkey as "Postcode",
          case when n_regionkey <> 0 then '01382 ' || s_suppkey end as "TelephoneNumber"
        from supplier join nation on s_nationkey = n_nationkey
          join region on n_regionkey = r_regionkey""",
    "register": 'select *, row_number() over (order by "PracticeCode") as ordinal from practices',
}

_NEEDS = {"gappy_calls": ("calls",), "register": ("practices",)}


def with_tables(*names: str, body: str) -> str:
    """SQL text that starts from the named data sets."""
    wanted: list[str] = []
    for name in names:
        wanted += [n for n in (*_NEEDS.get(name, ()), name) if n not in wanted]
    ctes = ", ".join(f"{name} as ({SQL[name]})" for name in wanted)
    return f"with {ctes} {body}"
