"""A store of documents by id: folders of JSON lines, parted by the id's hash.

``<root>/<resource>/parts=<n>/part=<k>/`` holds the documents whose id falls into part ``k`` of ``n``. A put
writes only the parts that hold one of its ids again, from a copy that is finished before they are touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.operators.keys import latest_per_key
from wardflow.session import delete_folder, discard, folder_exists, folder_names, materialize, scratch_path

#: Parts of a new store. More parts make a put cheaper and files smaller.
PARTS = 64

_LINES = "value string, part int"


def put_documents(
    df: DataFrame,
    root: str,
    resource: str,
    body: str = "resource_json",
    arrival: str | None = None,
    parts: int = PARTS,
) -> None:
    """Put documents (``id`` and their text) into the folder of their resource type, by id.

    A document whose id is stored already replaces the stored one; of several with one id the last by
    the column ``arrival`` wins, and of equal ones, or without such a column, the text that sorts last.
    New ids are added to their part's folder. Parts that hold a replaced id are written again; a
    run that fails while they are being replaced is finished by the next put or by ``finish_put``.
    ``parts`` counts for a store that does not exist yet.
    """
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{resource}"
    finish_put(spark, root, resource)
    parts = _parts(spark, path) or parts
    columns = [F.col("id"), F.col(body).alias("value")] + ([F.col(arrival).alias("arrival")] if arrival else [])
    latest = latest_per_key(df.select(*columns), ["id"], ["arrival", "value"] if arrival else ["value"])
    copy = scratch_path(spark, "puts")
    puts = materialize(latest.select("id", "value", _part(parts).alias("part")), "puts", copy)
    # At most ``parts`` numbers each.
    touched = _numbers(puts)
    target, again = f"{path}/parts={parts}", []
    if touched and folder_exists(spark, target):
        lines = spark.read.schema(_LINES).text(target).filter(F.col("part").isin(touched))
        held = lines.select(F.get_json_object("value", "$.id").alias("id"), "value", "part")
        again = _numbers(held.join(puts, "id", "left_semi"))
        if again:
            rest = held.filter(F.col("part").isin(again)).join(puts.select("id"), "id", "left_anti")
            merged = rest.unionByName(puts.filter(F.col("part").isin(again)))
            _write(merged, f"{_staged(root, resource)}/parts={parts}", "errorifexists")
            finish_put(spark, root, resource)
    fresh = puts.filter(~F.col("part").isin(again)) if again else puts
    if set(touched) - set(again):
        _write(fresh, target, "append")
    discard(spark, copy)


def finish_put(spark: SparkSession, root: str, resource: str) -> bool:
    """Replace the parts that an earlier put had finished copying; tells whether there were any.

    Replacing them once more changes nothing, so it does not matter where that run stopped. A copy that
    was not finished goes: its parts have not been touched.
    """
    staged = _staged(root, resource)
    if not folder_exists(spark, staged):
        return False
    (name,) = folder_names(spark, staged) or [None]
    whole = name is not None and folder_exists(spark, f"{staged}/{name}/_SUCCESS")
    if whole:
        rows = spark.read.schema(_LINES).text(f"{staged}/{name}")
        _write(rows, f"{root.rstrip('/')}/{resource}/{name}", "overwrite")
    delete_folder(spark, staged)
    return whole


def _staged(root: str, resource: str) -> str:
    """A folder beside the resource's, which readers pass over for its name."""
    return f"{root.rstrip('/')}/_put-{resource}"


def _parts(spark: SparkSession, path: str) -> int | None:
    """How many parts a store has; none if it does not exist."""
    names = [n for n in folder_names(spark, path) if not n.startswith(("_", "."))] if folder_exists(spark, path) else []
    if not names:
        return None
    if len(names) > 1 or not names[0].startswith("parts="):
        raise ValueError(f"not a store of documents by id: {path}")
    return int(names[0].removeprefix("parts="))


def _part(parts: int) -> Column:
    # Documents without an id replace nothing and are spread by their text.
    return F.pmod(F.xxhash64(F.coalesce("id", "value")), F.lit(parts)).cast("int")


def _numbers(rows: DataFrame) -> list[int]:
    return sorted(r["part"] for r in rows.select("part").distinct().collect())


def _write(rows: DataFrame, path: str, mode: str) -> None:
    writer = rows.select("value", "part").write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("part").text(path)
