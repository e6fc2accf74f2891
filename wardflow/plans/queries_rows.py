"""Row routing: complete and incomplete rows, casts, batches, pages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.operators.keys import bucketed_table, skip_processed
from wardflow.operators.merge import as_inserts, merge_changes
from wardflow.operators.ordinals import fan_out, micro_batch_ids, rotation_windows
from wardflow.operators.quality import (
    cast_or_reject,
    round_columns,
    split_counts,
    split_missing,
    write_split,
)
from wardflow.operators.rotation import rotated_batches
from wardflow.plans import standins as d
from wardflow.plans.catalog import query
from wardflow.plans.standins import with_tables
from wardflow.session import materialize, scratch_path
from wardflow.sinks.files import (
    append_quarantine,
    clone_schema,
    quarantine_union,
    read_quarantine,
)
from wardflow.sources.files import from_folder
from wardflow.sources.messages import CORRUPT, decode_messages, encode_messages
from wardflow.sources.pages import explode_pages, first_records

_GAP = "call_centre is null or satisfaction_score is null"
_FEEDBACK_GAP = "overall_score is null"


@query("missing_rows", with_tables("gappy_calls", body=f"select * from gappy_calls where {_GAP}"))
def missing_rows(spark, sf_dir):
    return split_missing(d.gappy_calls(spark, sf_dir))[1]


@query(
    "clean_rows", with_tables("gappy_calls", body=f"select * from gappy_calls where not ({_GAP})")
)
def clean_rows(spark, sf_dir):
    return split_missing(d.gappy_calls(spark, sf_dir))[0]


@query(
    "split_counts",
    with_tables(
        "gappy_feedback",
        body=f"""
        select count(*) as total_rows, count(*) filter (where not gap) as clean_rows,
          count(*) filter (where gap) as missing_rows
        from (select {_FEEDBACK_GAP} or feedback_type = 'view' as gap from gappy_feedback)""",
    ),
)
def split_counts_query(spark, sf_dir):
    # A score that is not a number counts as missing.
    score = F.when(F.col("feedback_type") == "view", F.lit("NaN").cast("double"))
    feedback = d.gappy_feedback(spark, sf_dir).withColumn(
        "overall_score", score.otherwise(F.col("overall_score"))
    )
    return split_counts(feedback)


@query(
    "split_written",
    with_tables(
        "gappy_calls",
        body=f"""
        select *, case when {_GAP} then 'missing' else 'clean' end as outcome from gappy_calls""",
    ),
)
def split_written(spark, sf_dir):
    path = scratch_path(spark, "split")
    write_split(d.gappy_calls(spark, sf_dir), path)
    return spark.read.parquet(path)


@query(
    "missing_union_quarantine",
    with_tables(
        "gappy_calls",
        "gappy_feedback",
        body=f"""
        select *, 'calls' as dataset from gappy_calls where {_GAP}
        union all by name
        select *, 'feedback' as dataset from gappy_feedback where {_FEEDBACK_GAP}""",
    ),
)
def missing_union_quarantine(spark, sf_dir):
    return quarantine_union(
        {
            "calls": split_missing(d.gappy_calls(spark, sf_dir))[1],
            "feedback": split_missing(d.gappy_feedback(spark, sf_dir))[1],
        }
    )


@query(
    "quarantine_folder",
    with_tables(
        "gappy_calls",
        "gappy_feedback",
        body=f"""
        select dataset, patient_id, call_id, feedback_id from (
          select *, 'calls' as dataset from gappy_calls where {_GAP}
          union all by name
          select *, 'feedback' as dataset from gappy_feedback where {_FEEDBACK_GAP})""",
    ),
)
def quarantine_folder(spark, sf_dir):
    path = scratch_path(spark, "quarantine")
    append_quarantine(split_missing(d.gappy_calls(spark, sf_dir))[1], path, "calls")
    append_quarantine(split_missing(d.gappy_feedback(spark, sf_dir))[1], path, "feedback")
    return read_quarantine(spark, path).select("dataset", "patient_id", "call_id", "feedback_id")


@query("rounded_scores", "select event_id, round(value) as value from events")
def rounded_scores(spark, sf_dir):
    return round_columns(d.table(spark, sf_dir, "events").select("event_id", "value"), ["value"])


_CAST_INPUT = """
    select event_id, case when event_type = 'error' then 'k' || k else k end as k,
      case when event_type = 'view' then 'on ' || day else day end as day
    from (select event_id, event_type, json_extract_string(props, '$.k') as k,
      strftime(ts, '%Y-%m-%d') as day from events)"""


def _untyped(spark, sf_dir):
    events = d.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    day = F.date_format("ts", "yyyy-MM-dd")
    return events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.concat(F.lit("k"), k)).otherwise(k).alias("k"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("on "), day)).otherwise(day).alias("day"),
    )


_TYPED = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("day", T.DateType())])


@query(
    "bad_cast_rejects",
    f"""
    select event_id, k, day, array_to_string(list_filter([
        case when k is not null and try_cast(k as integer) is null then 'k' end,
        case when day is not null and try_cast(day as date) is null then 'day' end],
        lambda x: x is not null), ',') as bad_columns
    from ({_CAST_INPUT})
    where try_cast(k as integer) is null or try_cast(day as date) is null""",
)
def bad_cast_rejects(spark, sf_dir):
    rejects = cast_or_reject(_untyped(spark, sf_dir), _TYPED, keep=["event_id"])[1]
    return rejects.withColumn("bad_columns", F.array_join("bad_columns", ","))


@query(
    "good_casts",
    f"""
    select event_id, try_cast(k as integer) as k, try_cast(day as date) as day
    from ({_CAST_INPUT})
    where try_cast(k as integer) is not null and try_cast(day as date) is not null""",
)
def good_casts(spark, sf_dir):
    return cast_or_reject(_untyped(spark, sf_dir), _TYPED, keep=["event_id"])[0]


@query(
    "stage_by_path",
    "select page_id, url as folder_name from pages where url like '%/en/%'",
)
def stage_by_path(spark, sf_dir):
    pages = d.table(spark, sf_dir, "pages")
    return from_folder(pages.select("page_id", F.col("url").alias("folder_name")), "/en")


_SKIPPED_SQL = """
    select o_orderkey, o_custkey, o_totalprice from orders
    where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')"""


def _stored_and_done(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    returned = d.table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return orders, returned.select(F.col("l_orderkey").alias("o_orderkey"))


@query("skip_processed", _SKIPPED_SQL)
def skip_processed_query(spark, sf_dir):
    return skip_processed(*_stored_and_done(spark, sf_dir), "o_orderkey")


@query("skip_processed_bucketed", _SKIPPED_SQL)
def skip_processed_bucketed(spark, sf_dir):
    """The same with rows and done list kept in buckets, the list added to in two runs."""
    orders, done = _stored_and_done(spark, sf_dir)

    def kept(rows, label, *parts):
        path = scratch_path(spark, label)
        name = path.rsplit("/", 1)[1].replace("-", "_")
        for part in parts:
            table = bucketed_table(rows.filter(part), name, path, "o_orderkey", 32)
        return table

    late = F.col("o_orderkey") % 4 == 0
    return skip_processed(kept(orders, "stored", F.lit(True)), kept(done, "done", ~late, late), "o_orderkey")


@query("empty_clone", "select o_orderkey, o_custkey, o_totalprice from orders")
def empty_clone(spark, sf_dir):
    """An empty clone of a table, filled by merging the whole table into it."""
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = scratch_path(spark, "clone")
    clone_schema(orders, path)
    return merge_changes(spark.read.parquet(path), as_inserts(orders), ["o_orderkey"])


@query(
    "fanout_ids",
    """
    select 'P' || s_suppkey || '-' || format('{:02d}', n) as patient_id
    from supplier, (select unnest(range(1, 101)) as n)""",
)
def fanout_ids(spark, sf_dir):
    from wardflow.documents.build import patient_ids

    return patient_ids(
        d.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("PracticeCode"))
    )


@query(
    "fanned_counters",
    with_tables(
        "register",
        body="""
        select "PracticeCode", n, (ordinal - 1) * each + n as counter,
          ((ordinal - 1) * each + n - 1) % 100 + 1 as number
        from register,
          (select (select count(*) from customer) // (select count(*) from supplier) as each),
          (select unnest(range(1, 1 + (select count(*) from customer) // (select count(*) from supplier))) as n)""",
    ),
)
def fanned_counters(spark, sf_dir):
    from wardflow.documents.build import numbered_copies, share_per_practice
    from wardflow.functions.numbers import wrapped

    customers = d.table(spark, sf_dir, "customer").agg(F.count("*")).scalar()
    each = share_per_practice(d.table(spark, sf_dir, "supplier"), customers)
    rows = numbered_copies(d.register(spark, sf_dir), each)
    return rows.select("PracticeCode", "n", "counter", wrapped("counter").alias("number"))


_PAGE_LIMIT = 30


def _register_pages(spark, sf_dir):
    """The register as landed from its service; a page never holds more than its limit."""
    practices = d.practices(spark, sf_dir)
    page_no = F.expr(f"PracticeCode div {_PAGE_LIMIT}")
    pages = (
        practices.groupBy(page_no.alias("page_no"))
        .agg(F.array_sort(F.collect_list(F.struct(*practices.columns))).alias("records"))
        .select("page_no", F.struct("records").alias("result"))
    )
    return materialize(pages, "pages")


@query(
    "page_records",
    with_tables("register", body="select * from register"),
)
def page_records(spark, sf_dir):
    return explode_pages(_register_pages(spark, sf_dir), _PAGE_LIMIT)


@query("page_records_uneven", with_tables("register", body="select * from register"))
def page_records_uneven(spark, sf_dir):
    """Pages of very different sizes, short ones in the middle: every landed record is kept."""
    practices = d.practices(spark, sf_dir)
    uneven = F.floor(F.sqrt(F.col("PracticeCode") + 1)).alias("page_no")
    pages = practices.groupBy(uneven).agg(
        F.struct(F.array_sort(F.collect_list(F.struct(*practices.columns))).alias("records")).alias("result")
    )
    return explode_pages(materialize(pages, "pages"))


@query(
    "first_records",
    with_tables(
        "register", body='select ordinal, "PracticeCode" from register order by ordinal limit 25'
    ),
)
def first_records_query(spark, sf_dir):
    records = explode_pages(_register_pages(spark, sf_dir), _PAGE_LIMIT)
    return first_records(records.select("ordinal", "PracticeCode"), 25)


@query(
    "micro_batches",
    """
    select event_id, (row_number() over (order by ts, event_id) - 1) // 1000 + 1 as batch_id
    from events""",
)
def micro_batches(spark, sf_dir):
    events = d.table(spark, sf_dir, "events").select("event_id", "ts")
    return micro_batch_ids(events, ["ts", "event_id"], 1000).drop("ts")


@query(
    "micro_batches_by_type",
    """
    select event_id, event_type,
      (row_number() over (partition by event_type order by ts, event_id) - 1) // 1000 + 1 as batch_id
    from events""",
)
def micro_batches_by_type(spark, sf_dir):
    events = d.table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return micro_batch_ids(events, ["ts", "event_id"], 1000, within=["event_type"]).drop("ts")


@query(
    "rotation_windows",
    "select date_trunc('minute', ts) as window_start, count(*) as row_count from events group by all",
)
def rotation_windows_query(spark, sf_dir):
    events = rotation_windows(d.table(spark, sf_dir, "events"), "ts", "60 seconds")
    return events.groupBy("window_start").agg(F.count("*").alias("row_count"))


ROTATED_SQL = """
    with recursive rows as (
      select event_id, ts, row_number() over (order by ts, event_id) as n,
        lag(ts) over (order by ts, event_id) as before
      from events),
    timed as (select *, before is null or ts - before > interval 25 minutes as begins from rows),
    due as (
      select *, case when begins then ts else before end + interval 1 hour as due,
        min(case when begins then n end) over (order by n rows between 1 following and unbounded following) as gap
      from timed),
    firsts as (select ts, min(n) as n from rows group by ts),
    links as materialized (
      select d.n, least(d.n + 20, coalesce(f.n + 1, d.n + 20), coalesce(gap, d.n + 20)) as next
      from due d asof left join firsts f on d.due <= f.ts),
    starts(n, batch_id) as (
      select cast(1 as bigint), cast(1 as bigint)
      union all select l.next, s.batch_id + 1 from starts s join links l on l.n = s.n
      where l.next <= (select max(n) from rows))
    select event_id, batch_id from rows asof join starts on rows.n >= starts.n"""


@query("rotated_batches", ROTATED_SQL)
def rotated_batches_query(spark, sf_dir):
    events = d.table(spark, sf_dir, "events").select("event_id", "ts")
    return rotated_batches(events, "ts", ["event_id"], 20, 3600, 25 * 60, span=2000).drop("ts")


_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


@query("csv_message_roundtrip", "select event_id, ts, event_type, value, props from events")
def csv_message_roundtrip(spark, sf_dir):
    events = d.table(spark, sf_dir, "events").select(*_EVENT.names)
    messages = encode_messages(events, quoted=["props"])
    return decode_messages(messages, _EVENT).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


@query(
    "csv_messages",
    """
    select o_orderkey || ',' || o_custkey || ',' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f')
      || ',"' || o_orderpriority || '",' || o_orderstatus as value from orders""",
)
def csv_messages(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders")
    return encode_messages(
        orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"),
        quoted=["o_orderpriority"],
    )


@query(
    "exploded_copies",
    """
    select o_orderkey, n from (select o_orderkey, unnest(range(1, 2 + o_custkey % 4)) as n from orders)""",
)
def exploded_copies(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return fan_out(orders, F.col("o_custkey") % 4 + 1, "n", chunk=2).select("o_orderkey", "n")
