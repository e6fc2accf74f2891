"""Pages of the practice register, as landed from its service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.schemas import PAGE_ENVELOPE


def read_pages(spark: SparkSession, path: str, page_pattern: str = r"(\d+)\.json$") -> DataFrame:
    """Landed page files; the page number is taken from the file name."""
    pages = spark.read.schema(PAGE_ENVELOPE).option("multiLine", True).json(path)
    number = F.regexp_extract(F.col("_metadata.file_path"), page_pattern, 1).cast("long")
    return pages.select(number.alias("page_no"), "result")


def explode_pages(
    pages: DataFrame,
    limit: int | None = None,
    page_no: str = "page_no",
    records: str = "result.records",
) -> DataFrame:
    """All records of the landed pages, with their ``ordinal`` in the register.

    Pages follow each other by number, whatever their sizes. ``limit`` is what a full page holds: a
    larger page, or records after a page that was not full, mean that pages are missing or mixed up
    and fail the job, and so does a page that landed twice. Only one row per page is ordered.
    """
    sized = pages.select(
        F.col(page_no).alias("_page"),
        F.col(records).alias("_records"),
        F.coalesce(F.size(F.col(records)), F.lit(0)).alias("_size"),
    )
    ahead = W.orderBy("_page").rowsBetween(W.unboundedPreceding, -1)
    placed = sized.groupBy("_page").agg(F.sum("_size").alias("_held"), F.count("*").alias("_landed"))
    before = F.coalesce(F.sum("_held").over(ahead), F.lit(0).cast("long"))
    checked = F.when(F.col("_landed") > 1, F.raise_error(F.lit("a page landed twice")))
    if limit is not None:
        ended = F.coalesce(F.max(F.col("_held") < limit).over(ahead), F.lit(False))
        checked = checked.when(
            F.col("_held") > limit, F.raise_error(F.lit(f"a page holds more than {limit} records"))
        ).when(ended & (F.col("_held") > 0), F.raise_error(F.lit("records after the last page")))
    placed = placed.select(F.col("_page").alias("_placed"), checked.otherwise(before).alias("_before"))
    joined = sized.join(placed, F.col("_page").eqNullSafe(F.col("_placed")))
    return joined.select("_before", F.posexplode("_records")).select(
        (F.col("_before") + F.col("pos") + 1).alias("ordinal"), "col.*"
    )


def first_records(records: DataFrame, count: int, order: str = "ordinal") -> DataFrame:
    """The first ``count`` records of the register."""
    return records.orderBy(order).limit(count)
