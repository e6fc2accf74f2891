"""Merges and change feeds over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.operators.keys import latest_per_key
from wardflow.operators.merge import (
    as_inserts,
    kept_snapshot_changes,
    merge_changes,
    put_resources,
    snapshot_changes,
    write_snapshot,
)
from wardflow.plans import standins as d
from wardflow.plans.catalog import query
from wardflow.session import scratch_path
from wardflow.sinks.store import put_documents
from wardflow.sources.files import read_resource
from wardflow.streaming.upsert import ProcessedTable

COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def processed(spark, sf_dir):
    """What the processed table holds: all orders that are no longer open."""
    orders = d.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "O")
    return orders.select(*COLUMNS)


def changes(spark, sf_dir):
    """One change per order: urgent ones go, high and medium ones are repriced, the others come."""
    priority = F.col("o_orderpriority")
    action = (
        F.when(priority == "1-URGENT", "DELETE")
        .when(priority.isin("2-HIGH", "3-MEDIUM"), "UPDATE")
        .otherwise("INSERT")
    )
    return d.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.lit("U").alias("o_orderstatus"),
        (F.col("o_totalprice") + 100).alias("o_totalprice"),
        "o_orderdate",
        action.alias("action"),
    )


def versioned_changes(spark, sf_dir):
    """The same changes, followed by a second one for each order above 250,000."""
    first = changes(spark, sf_dir).withColumn("seq", F.lit(1).cast("long"))
    second = (
        first.filter(F.col("o_totalprice") > 250100)
        .withColumn("seq", F.lit(2).cast("long"))
        .withColumn("o_orderstatus", F.lit("V"))
        .withColumn(
            "action",
            F.when(F.col("action") == "DELETE", "UPDATE")
            .when(F.col("action") == "UPDATE", "INSERT")
            .otherwise("DELETE"),
        )
    )
    return first.unionByName(second)


_COLS = ", ".join(COLUMNS)
TARGET_SQL = f"target as (select {_COLS} from orders where o_orderstatus <> 'O')"
CHANGES_SQL = """changes as (
    select o_orderkey, o_custkey, 'U' as o_orderstatus, o_totalprice + 100 as o_totalprice, o_orderdate,
      case when o_orderpriority = '1-URGENT' then 'DELETE'
        when o_orderpriority in ('2-HIGH', '3-MEDIUM') then 'UPDATE' else 'INSERT' end as action
    from orders)"""
VERSIONED_SQL = """versioned as (
    select *, 1 as seq from changes
    union all
    select o_orderkey, o_custkey, 'V', o_totalprice, o_orderdate,
      case action when 'DELETE' then 'UPDATE' when 'UPDATE' then 'INSERT' else 'DELETE' end, 2
    from changes where o_totalprice > 250100)"""


def merged_sql(changes_name: str) -> str:
    return f"""
    select {_COLS} from target t
    where not exists (select 1 from {changes_name} c where c.o_orderkey = t.o_orderkey
      and c.action in ('DELETE', 'UPDATE'))
    union all
    select {_COLS} from {changes_name} c where action = 'UPDATE'
      and exists (select 1 from target t where t.o_orderkey = c.o_orderkey)
    union all
    select {_COLS} from {changes_name} c where action = 'INSERT'
      and not exists (select 1 from target t where t.o_orderkey = c.o_orderkey)"""


_NEWEST = """newest as (select * from versioned
    qualify row_number() over (partition by o_orderkey order by seq desc) = 1)"""


@query("merge_changes", f"with {TARGET_SQL}, {CHANGES_SQL} {merged_sql('changes')}")
def merge_changes_query(spark, sf_dir):
    return merge_changes(processed(spark, sf_dir), changes(spark, sf_dir), ["o_orderkey"])


@query(
    "merge_latest_change",
    f"with {TARGET_SQL}, {CHANGES_SQL}, {VERSIONED_SQL}, {_NEWEST} {merged_sql('newest')}",
)
def merge_latest_change(spark, sf_dir):
    return merge_changes(
        processed(spark, sf_dir), versioned_changes(spark, sf_dir), ["o_orderkey"], seq_col="seq"
    )


def mixed_changes(spark, sf_dir):
    """Changes of held and new keys at once: each order's change, an insert beside it, a repeated insert of
    every tenth order, and changes without a key."""
    own = changes(spark, sf_dir)
    beside = own.withColumn("action", F.lit("INSERT")).withColumn("o_orderstatus", F.lit("I"))
    again = beside.filter(F.col("o_orderkey") % 10 == 0)
    keyless = own.filter(F.col("o_orderkey") % 50 == 0).withColumn(
        "o_orderkey", F.lit(None).cast(own.schema["o_orderkey"].dataType)
    )
    return own.unionByName(beside).unionByName(again).unionByName(keyless)


MIXED_SQL = """mixed as (
    select * from changes
    union all select o_orderkey, o_custkey, 'I', o_totalprice, o_orderdate, 'INSERT' from changes
    union all select o_orderkey, o_custkey, 'I', o_totalprice, o_orderdate, 'INSERT' from changes
      where o_orderkey % 10 = 0
    union all select null, o_custkey, o_orderstatus, o_totalprice, o_orderdate, action from changes
      where o_orderkey % 50 = 0)"""


@query("merge_mixed_batch", f"with {TARGET_SQL}, {CHANGES_SQL}, {MIXED_SQL} {merged_sql('mixed')}")
def merge_mixed_batch(spark, sf_dir):
    return merge_changes(processed(spark, sf_dir), mixed_changes(spark, sf_dir), ["o_orderkey"])


@query(
    "processed_mixed_batch",
    f"""with {TARGET_SQL}, {CHANGES_SQL}, {MIXED_SQL}, merged as ({merged_sql('mixed')})
    select 'large' as segments, * from merged union all select 'tiny', * from merged""",
)
def processed_mixed_batch(spark, sf_dir):
    """The same through processed tables that hardly ever and always put their segments together."""
    found = []
    for name, most in (("large", 1000), ("tiny", 1)):
        target = processed(spark, sf_dir)
        table = ProcessedTable.create(target, scratch_path(spark, "mixed"), ["o_orderkey"], most)
        table.apply(as_inserts(target))
        table.apply(mixed_changes(spark, sf_dir))
        found.append(table.read().select(F.lit(name).alias("segments"), "*"))
    return found[0].unionByName(found[1])


@query("merge_growing_buckets", f"with {TARGET_SQL}, {CHANGES_SQL} {merged_sql('changes')}")
def merge_growing_buckets(spark, sf_dir):
    """The merge into a table that comes in parts and splits its buckets at 2,000 rows on average."""
    start = as_inserts(processed(spark, sf_dir))
    path = scratch_path(spark, "growing")
    table = ProcessedTable.create(processed(spark, sf_dir), path, ["o_orderkey"], buckets=1, bucket_rows=2000)
    third = F.pmod(F.col("o_orderkey"), F.lit(3))
    for part in range(3):
        table.apply(start.filter(third == part))
    table.apply(changes(spark, sf_dir))
    return table.read()


@query(
    "latest_versions",
    f"with {CHANGES_SQL}, {VERSIONED_SQL}, {_NEWEST} select * from newest",
)
def latest_versions(spark, sf_dir):
    newest = latest_per_key(versioned_changes(spark, sf_dir), ["o_orderkey"], ["seq"])
    return newest.withColumn("seq", F.col("seq").cast("int"))


@query(
    "put_resources",
    f"""with {TARGET_SQL}, {CHANGES_SQL}, {VERSIONED_SQL}, puts as (
      select * from versioned where action <> 'DELETE'
      qualify row_number() over (partition by o_orderkey order by seq desc) = 1)
    select {_COLS} from target where o_orderkey not in (select o_orderkey from puts)
    union all select {_COLS} from puts""",
)
def put_resources_query(spark, sf_dir):
    puts = versioned_changes(spark, sf_dir).filter(F.col("action") != "DELETE")
    return put_resources(processed(spark, sf_dir), puts, ["o_orderkey"], ["seq"])


@query(
    "put_last_arrival",
    """
    select 'U' || user_id as id, event_id, event_type from events
    qualify row_number() over (partition by user_id order by event_id % 3 desc, event_id desc) = 1""",
)
def put_last_arrival(spark, sf_dir):
    """Three puts of each user's events: in the store is the last that arrived in the last put."""
    events, store = d.table(spark, sf_dir, "events"), scratch_path(spark, "store")
    kinds = F.struct(F.concat(F.lit("U"), F.col("user_id")).alias("id"), "event_type", "event_id")
    docs = events.select(kinds["id"].alias("id"), F.to_json(kinds).alias("resource_json"), "event_id")
    for turn in range(3):
        put_documents(docs.filter(F.col("event_id") % 3 == turn), store, "Event", arrival="event_id", parts=8)
    body = F.from_json("raw_data", "id string, event_id long, event_type string").alias("d")
    return read_resource(spark, store, "Event").select(body).select("d.*")


_SNAPSHOT_SQL = """
    with old as (select o_orderkey, o_custkey, o_totalprice from orders where o_orderstatus <> 'P'),
    new as (select o_orderkey, o_custkey,
        o_totalprice + case when o_orderpriority = '1-URGENT' then 1 else 0 end as o_totalprice
      from orders where o_orderstatus <> 'F')
    select o_orderkey, o_custkey, o_totalprice, 'DELETE' as action from old
      where o_orderkey not in (select o_orderkey from new)
    union all select o_orderkey, o_custkey, o_totalprice, 'INSERT' from new
      where o_orderkey not in (select o_orderkey from old)
    union all select n.o_orderkey, n.o_custkey, n.o_totalprice, 'UPDATE'
      from new n join old o on n.o_orderkey = o.o_orderkey
      where n.o_custkey <> o.o_custkey or n.o_totalprice <> o.o_totalprice"""


@query("snapshot_changes", _SNAPSHOT_SQL)
def snapshot_changes_query(spark, sf_dir):
    return snapshot_changes(*_snapshots(spark, sf_dir), ["o_orderkey"])


@query("snapshot_changes_pruned", _SNAPSHOT_SQL)
def snapshot_changes_pruned(spark, sf_dir):
    """The same from snapshots kept with digests."""
    snapshots, paths = _snapshots(spark, sf_dir), [scratch_path(spark, "snapshot") for _ in range(2)]
    for rows, path in zip(snapshots, paths):
        write_snapshot(rows, path, ["o_orderkey"], 32)
    return kept_snapshot_changes(spark, *paths, snapshots[0].schema, ["o_orderkey"])


def _snapshots(spark, sf_dir):
    orders = d.table(spark, sf_dir, "orders")
    rise = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    old = orders.filter(F.col("o_orderstatus") != "P")
    new = orders.filter(F.col("o_orderstatus") != "F").withColumn(
        "o_totalprice", F.col("o_totalprice") + rise
    )
    names = ["o_orderkey", "o_custkey", "o_totalprice"]
    return old.select(*names), new.select(*names)
