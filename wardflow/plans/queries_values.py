"""Column functions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow import codes
from wardflow.documents.flatten import flatten, value
from wardflow.functions import numbers, text, times
from wardflow.plans import standins as d
from wardflow.plans.catalog import query
from wardflow.plans.standins import sql_pick, with_tables


@query(
    "row_mean_score",
    """
    select l_orderkey, l_linenumber, l_partkey,
      (l_quantity + l_extendedprice + l_discount + l_tax) / 4 as overall_score from lineitem""",
)
def row_mean_score(spark, sf_dir):
    mean = numbers.row_mean(["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return d.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", mean.alias("overall_score")
    )


@query(
    "json_path_values",
    """
    select event_id, cast(json_extract_string(props, '$.k') as integer) as k,
      json_extract_string(props, '$.k') as k_text, cast(null as timestamp) as absent
    from events""",
)
def json_path_values(spark, sf_dir):
    spec = (
        value("k", "int", "k"),
        value("k_text", "string", "k"),
        value("absent", "timestamp", "meta.lastUpdated"),
    )
    events = d.table(spark, sf_dir, "events")
    flat = flatten(events, spec, body="props", keep=["event_id"])
    return flat.withColumn("absent", F.col("absent").cast("timestamp_ntz"))


@query(
    "id_after_slash",
    "select page_id, nullif(regexp_extract(url, '[^/]+$'), '') as id from pages",
)
def id_after_slash(spark, sf_dir):
    pages = d.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.last_segment("url").alias("id"))


@query(
    "slug_names",
    with_tables(
        "practices",
        body="""
        select "PracticeCode",
          regexp_replace(lower(replace("GPPracticeName", ' ', '')), '[^a-z0-9]', '', 'g') as slug,
          lower(replace("GPPracticeName", ' ', '')) as squashed,
          lower(replace("GPPracticeName", ' ', '')) || '@nhs.scot.co.uk' as email,
          'https://' || regexp_replace(lower(replace("GPPracticeName", ' ', '')), '[^a-z0-9-]', '', 'g')
            || '.com' as site
        from practices""",
    ),
)
def slug_names(spark, sf_dir):
    name = F.col("GPPracticeName")
    return d.practices(spark, sf_dir).select(
        "PracticeCode",
        text.slug(name).alias("slug"),
        text.squashed(name).alias("squashed"),
        text.email_of(text.squashed(name)).alias("email"),
        text.site_of(text.slug(name, keep_dash=True), "https").alias("site"),
    )


@query(
    "padded_ids",
    """
    select o_orderkey, 'CL-' || format('{:03d}', o_orderkey) as call_id,
      'A' || format('{:05d}', o_orderkey) as appointment_id,
      'P' || o_custkey || '-' || format('{:02d}', o_orderkey % 100 + 1) as patient_id
    from orders""",
)
def padded_ids(spark, sf_dir):
    return d.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.padded_id("CL-", "o_orderkey", 3).alias("call_id"),
        text.padded_id("A", "o_orderkey", 5).alias("appointment_id"),
        text.patient_key("o_custkey", numbers.wrapped(F.col("o_orderkey") + 1)).alias("patient_id"),
    )


@query(
    "clean_address",
    with_tables(
        "practices",
        body="""
        select "PracticeCode",
          array_to_string(list_filter(["AddressLine1", "AddressLine2", "AddressLine3"],
            lambda x: x <> ''), ', ') as lines,
          coalesce(nullif("AddressLine4", ''), "AddressLine3") as city,
          coalesce("TelephoneNumber", 'none') as phone
        from practices""",
    ),
)
def clean_address(spark, sf_dir):
    parts = text.present_parts("AddressLine1", "AddressLine2", "AddressLine3")
    return d.practices(spark, sf_dir).select(
        "PracticeCode",
        F.array_join(parts, ", ").alias("lines"),
        text.first_present("AddressLine4", "AddressLine3").alias("city"),
        text.default_to("TelephoneNumber", "none").alias("phone"),
    )


_MARITAL = tuple(codes.MARITAL_STATUSES) + ("X",)


@query(
    "code_display",
    f"""
    select c_custkey, code, case code when 'M' then 'Married' when 'S' then 'Never Married'
      when 'D' then 'Divorced' when 'W' then 'Widowed' when 'L' then 'Legally Separated' end as display
    from (select c_custkey, {sql_pick(_MARITAL, "c_custkey")} as code from customer)""",
)
def code_display(spark, sf_dir):
    customers = d.table(spark, sf_dir, "customer").select(
        "c_custkey", d.pick(_MARITAL, F.col("c_custkey")).alias("code")
    )
    return customers.withColumn("display", text.lookup("code", codes.MARITAL_STATUSES))


@query(
    "capitalized",
    "select c_custkey, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) as word from customer",
)
def capitalized(spark, sf_dir):
    customers = d.table(spark, sf_dir, "customer")
    return customers.select("c_custkey", text.capitalized("c_mktsegment").alias("word"))


@query(
    "dates_formatted_shifted",
    """
    select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day_text,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as second_text,
      strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f+00:00') as iso_text,
      o_orderdate + to_days(cast(o_custkey % 30 as integer)) + to_minutes(30) as end_time
    from orders""",
)
def dates_formatted_shifted(spark, sf_dir):
    days = (F.col("o_custkey") % 30).cast("int")
    return d.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        times.day_text("o_orderdate").alias("day_text"),
        times.second_text("o_orderdate").alias("second_text"),
        times.iso_text("o_orderdate").alias("iso_text"),
        times.shifted("o_orderdate", days=days, minutes=30).alias("end_time"),
    )


@query(
    "numbers_as_text",
    "select s_suppkey, cast(s_suppkey as varchar) as id, (s_suppkey + 149) % 100 + 1 as wrapped from supplier",
)
def numbers_as_text(spark, sf_dir):
    return d.table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.col("s_suppkey").cast("string").alias("id"),
        numbers.wrapped(F.col("s_suppkey") + 150).alias("wrapped"),
    )
