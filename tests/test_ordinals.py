from __future__ import annotations

from pyspark.sql import functions as F

from wardflow.operators.ordinals import (
    fan_out,
    micro_batch_ids,
    offset_batch_ids,
    rotation_windows,
    with_ordinal,
)


def test_ordinals_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("k"))
    found = with_ordinal(df, ["k"])
    assert found.columns == ["k", "ordinal"]
    assert found.filter("ordinal != k + 1").count() == 0
    assert found.count() == 5000


def test_numbers_start_again_per_group_also_when_one_group_is_large(spark):
    df = spark.range(0, 3000, 1, 5).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        "id",
    )
    found = with_ordinal(df, ["id"], within=["g"])
    stats = found.groupBy("g").agg(
        F.count("*").alias("n"), F.min("ordinal").alias("lo"), F.max("ordinal").alias("hi"),
        F.countDistinct("ordinal").alias("d"),
    )
    assert all(r.lo == 1 and r.hi == r.n == r.d for r in stats.collect())
    hot = [r.id for r in found.filter("g = 'hot'").orderBy("ordinal").collect()]
    assert hot == sorted(hot)


def test_groups_may_be_null(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, id int")
    found = {(r.g, r.id): r.ordinal for r in with_ordinal(df, ["id"], within=["g"]).collect()}
    assert found == {(None, 1): 1, (None, 2): 2, ("a", 3): 1}


def test_batches_have_the_given_size(spark):
    df = spark.range(0, 2500, 1, 3)
    sizes = micro_batch_ids(df, ["id"], 1000).groupBy("batch_id").count().orderBy("batch_id")
    assert [tuple(r) for r in sizes.collect()] == [(1, 1000), (2, 1000), (3, 500)]
    by_offset = offset_batch_ids(df.withColumnRenamed("id", "offset"), "offset", 1000)
    sizes = by_offset.groupBy("batch_id").count().orderBy("batch_id")
    assert [tuple(r) for r in sizes.collect()] == [(1, 1000), (2, 1000), (3, 500)]
    assert "Exchange" not in by_offset._jdf.queryExecution().executedPlan().toString()


def test_rotation_windows(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:59' as ts union all select timestamp'2024-01-01 00:01:00'")
    starts = [str(r.window_start) for r in rotation_windows(df, "ts").orderBy("ts").collect()]
    assert starts == ["2024-01-01 00:00:00", "2024-01-01 00:01:00"]


def test_fan_out_in_chunks(spark):
    df = spark.createDataFrame([("a", 25), ("b", 10), ("c", 0), ("d", 1)], "k string, copies long")
    found = fan_out(df, F.col("copies"), "n", chunk=10)
    numbers = {r.k: sorted(r.ns) for r in found.groupBy("k").agg(F.collect_list("n").alias("ns")).collect()}
    assert numbers == {"a": list(range(1, 26)), "b": list(range(1, 11)), "d": [1]}
    assert found.columns == ["k", "copies", "n"]
