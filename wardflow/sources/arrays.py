"""Documents from files of any size that hold them in one array, or one after another.

Files are cut at every closing brace, inside of texts too, and the pieces are put together again: a
piece's quotes tell whether the next one begins inside a text, its brackets how deep. Both are running
sums, kept per block of a file and then over blocks, so no task needs a file whole; it needs the
pieces of one block, and later those of one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.session import materialize

_BLOCK = ["path", "block"]


def read_array_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """The documents below ``path`` as ``folder_name``, ``raw_data`` and ``load_timestamp``.

    A file is one array, however it is laid out, or documents one after another. The elements of an
    array are its documents, also those that are no objects. Where the text between two documents
    cannot be read, it stays one document as it is, for whoever loads it to reject; the others of its
    file are not touched, unless a quote or bracket is missing: then what follows, to the end of the file
    at worst, is one such document in one task. Empty files and arrays have no documents.
    """
    pieces = materialize(_with_running_sums(_pieces(spark, path, glob)), "array-pieces")
    blocks = pieces.groupBy(*_BLOCK).agg(
        F.sum("quotes").alias("quotes"),
        F.sum("delta0").alias("d0"),
        F.sum("delta1").alias("d1"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
        F.max("file_size").alias("file_size"),
        F.min_by(F.ltrim(F.regexp_replace("value", "^[\\s\\uFEFF]+", "")), "at").alias("head"),
        F.max("at").alias("last_at"),
    )
    placed = pieces.join(_block_starts(blocks), _BLOCK)
    inside = F.pmod(F.col("inside") + F.col("quotes_before") + F.col("quotes"), F.lit(2)) == 1
    depth = F.col("depth") + F.when(F.col("inside") == 1, F.col("run1")).otherwise(F.col("run0"))
    last = F.col("is_last_block") & (F.col("at") == F.col("last_at"))
    # The text after a file's last brace is a piece too, unless there is none.
    braced = ~last | F.col("ends_braced")
    ends = ~inside & braced & (depth == F.col("is_array").cast("long"))
    found = placed.select(
        *_BLOCK,
        "at",
        "is_array",
        F.when(braced, F.concat("value", F.lit("}"))).otherwise(F.col("value")).alias("value"),
        ends.cast("long").alias("ends"),
    )
    found = materialize(found, "array-ends")
    per_block = found.groupBy(*_BLOCK).agg(F.sum("ends").alias("n"))
    ends_before = F.coalesce(F.sum("n").over(_before_in_file()), F.lit(0)).alias("documents_before")
    numbered = found.join(per_block.select(*_BLOCK, ends_before), _BLOCK)
    within = F.sum("ends").over(_in_block().rowsBetween(W.unboundedPreceding, W.currentRow))
    number = F.col("documents_before") + within - F.col("ends")
    stretches = (
        numbered.withColumn("number", number)
        .groupBy("path", "number")
        .agg(
            F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("parts"),
            F.max("is_array").alias("is_array"),
        )
        .select(
            F.col("path").alias("folder_name"),
            _stripped(F.array_join(F.col("parts.value"), "")).alias("raw_data"),
        )
        .filter(F.col("raw_data") != "")
    )
    # As a field, since what follows a whole array would be passed over.
    field = F.from_json(F.concat(F.lit('{"v":['), "raw_data", F.lit("]}")), "v array<string>")
    opened = F.explode(F.coalesce(field.getField("v"), F.array("raw_data"))).alias("raw_data")
    return stretches.select("folder_name", opened, F.current_timestamp().alias("load_timestamp"))


def _pieces(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """What lies between closing braces, with its place: file, block and running number."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    lines = reader.option("lineSep", "}").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def _with_running_sums(pieces: DataFrame) -> DataFrame:
    """Adds the quotes of a piece and those before it in its block, and how its depth changes, alone
    (``delta``) and up to here (``run``): 0 if the block begins outside of a text, 1 if inside."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    before = F.coalesce(F.sum("quotes").over(_in_block().rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counted = pieces.withColumn("quotes", quotes.cast("long"))
    counted = counted.withColumn("outer", _change(bare)).withColumn("inner", _change(F.concat(F.lit('"'), bare)))
    counted = counted.withColumn("quotes_before", before)
    # The brace that ends a piece counts where the piece ends outside of a text.
    even, closed = F.col("quotes_before") % 2 == 0, F.col("quotes") % 2 == 0
    outer, inner = F.col("outer") - closed.cast("long"), F.col("inner") - (~closed).cast("long")
    counted = counted.withColumn("delta0", F.when(even, outer).otherwise(inner))
    counted = counted.withColumn("delta1", F.when(even, inner).otherwise(outer)).drop("outer", "inner")
    so_far = _in_block().rowsBetween(W.unboundedPreceding, W.currentRow)
    return counted.withColumns({f"run{s}": F.sum(f"delta{s}").over(so_far) for s in (0, 1)})


def _change(bare: Column) -> Column:
    """Brackets opened less those closed, outside of texts."""
    outside = F.regexp_replace(bare, '"[^"]*("|$)', "")
    opened = F.length(outside) - F.length(F.translate(outside, "{[", ""))
    return (opened - F.length(outside) + F.length(F.translate(outside, "}]", ""))).cast("long")


def _block_starts(blocks: DataFrame) -> DataFrame:
    """Whether each block of a file begins inside of a text, and how deep; a row per block."""
    file = W.partitionBy("path")
    size = F.col("file_size") - F.sum("bytes").over(file)
    found = blocks.select(
        *_BLOCK,
        "last_at",
        "d0",
        "d1",
        F.pmod(F.coalesce(F.sum("quotes").over(_before_in_file()), F.lit(0)), F.lit(2)).alias("inside"),
        (F.col("block") == F.max("block").over(file)).alias("is_last_block"),
        # Counted with a brace each, the pieces make the file's size if there was a last one; a byte
        # order mark is three bytes that the pieces lack.
        size.isin(0, 3).alias("ends_braced"),
        F.first(F.col("head").startswith("[")).over(file.orderBy("block")).alias("is_array"),
    )
    change = F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1"))
    found = found.withColumn("change", change)
    depth = F.coalesce(F.sum("change").over(_before_in_file()), F.lit(0))
    return found.withColumn("depth", depth).drop("d0", "d1", "change")


def _stripped(text: Column) -> Column:
    """Without the array's own signs: a bracket or comma in front, a bracket behind the last document."""
    blank = F.regexp_replace(text, "^[\\s\\uFEFF]+|\\s+$", "")
    front = F.when(F.col("is_array"), F.regexp_replace(blank, "^[\\[,]", "")).otherwise(blank)
    behind = F.when(F.col("is_array") & ~blank.endswith("}"), F.regexp_replace(front, "\\]$", "")).otherwise(front)
    return F.trim(F.regexp_replace(behind, "^\\s+|\\s+$", ""))


def _in_block():
    return W.partitionBy(*_BLOCK).orderBy("at")


def _before_in_file():
    return W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
