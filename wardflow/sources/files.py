"""CSV, Parquet and document folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_dir(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """CSV files with a header line; a cell that does not fit its type reads as null.

    Quotes inside quoted cells are doubled, as ``encode_messages`` writes them. Without a schema the
    types are inferred, which reads the files twice and turns a column with a stray header line into
    text.
    """
    reader = spark.read.options(header=True, mode="PERMISSIVE", escape='"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_csv_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same files with every column as text, for ``cast_or_reject``."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    return spark.read.options(header=True, escape='"').schema(text).csv(path)


def read_parquet_dir(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    file_schema: T.StructType | None = None,
    glob: str = "*.parquet",
    skip_corrupt: bool = False,
) -> DataFrame:
    """Parquet files whose names match ``glob``, below ``path`` or several paths.

    With a schema, columns are found by name whatever their case and are null where the files lack
    them; no file is opened to find out what is in it. Where the files hold other types than wanted,
    ``file_schema`` says which, and the values are cast. With ``skip_corrupt`` what follows the first bad
    page of a file is left out, checksums of pages included; ``sources.history`` notes what that loses.
    """
    paths = [path] if isinstance(path, str) else path
    reader = spark.read.options(pathGlobFilter=glob, recursiveFileLookup=True, ignoreCorruptFiles=skip_corrupt)
    if skip_corrupt:
        # Otherwise a damaged page can be taken for other values, or fail beyond the reader.
        reader = reader.option("parquet.page.verify-checksum.enabled", True)
    if schema is None and file_schema is None:
        return reader.parquet(*paths)
    found = reader.schema(file_schema or schema).parquet(*paths)
    return found if schema is None or file_schema is None else match_columns(found, schema)


def unreadable_files(spark: SparkSession, path: str, rows: DataFrame, glob: str = "*.parquet") -> DataFrame:
    """``file_name`` of the files below ``path`` that are no Parquet files and gave ``rows`` nothing.

    For loads that skip what they cannot read (``skip_corrupt``). Files are listed, and only those
    without a row in ``rows`` are opened, to look for the format's marks at both ends; as many names
    as there are such files come to the driver.
    """

    def files(paths):
        listed = spark.read.format("binaryFile").option("pathGlobFilter", glob)
        return listed.option("recursiveFileLookup", True).load(paths)

    read = rows.select(F.col("_metadata.file_path").alias("path")).distinct()
    silent = [r.path for r in files(path).select("path").join(read, "path", "left_anti").collect()]
    if not silent:
        return files(path).select(F.col("path").alias("file_name")).limit(0)
    start, end = F.substring("content", 1, 4), F.expr("right(content, 4)")
    mark = F.lit("PAR1").cast("binary")
    return files(silent).filter((start != mark) | (end != mark)).select(F.col("path").alias("file_name"))


def match_columns(df: DataFrame, schema: T.StructType, cast: bool = True) -> DataFrame:
    """The columns of ``schema``, taken from ``df`` by name without regard to case.

    Without ``cast`` they keep the types they have, for ``cast_or_reject``.
    """
    by_name = {name.lower(): name for name in df.columns}

    def pick(field: T.StructField) -> Column:
        source = by_name.get(field.name.lower())
        value = F.lit(None).cast(field.dataType) if source is None else F.col(f"`{source}`")
        return (value.cast(field.dataType) if cast else value).alias(field.name)

    return df.select(*[pick(field) for field in schema])


def read_documents(
    spark: SparkSession, path: str, one_per_file: bool = False, glob: str = "*"
) -> DataFrame:
    """JSON documents as ``folder_name``, ``raw_data`` (JSON text) and ``load_timestamp``.

    One document per line, or per file with ``one_per_file``. An array of documents gives one row
    per element.
    """
    lines = (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .text(path, wholetext=one_per_file)
    )
    staged = lines.select(
        F.col("_metadata.file_path").alias("folder_name"),
        F.col("value").alias("raw_data"),
        F.current_timestamp().alias("load_timestamp"),
    )
    return explode_arrays(staged.filter(F.trim("raw_data") != ""))


def explode_arrays(docs: DataFrame, body: str = "raw_data") -> DataFrame:
    """One row per document where the text holds an array of them.

    Text that begins like an array but is not one stays a single document as it is, for whoever loads
    it to reject or to fail on.
    """
    is_array = F.ltrim(F.col(body)).startswith("[")
    elements = F.coalesce(F.from_json(F.col(body), "array<string>"), F.array(F.col(body)))
    opened = F.when(is_array, elements).otherwise(F.array(F.col(body)))
    return docs.withColumn(body, F.explode(opened))


def read_resource(
    spark: SparkSession, root: str, resource: str, one_per_file: bool = False
) -> DataFrame:
    """The documents in the folder of one resource type."""
    return read_documents(spark, f"{root.rstrip('/')}/{resource}", one_per_file)


def from_folder(docs: DataFrame, folder: str) -> DataFrame:
    """Staged documents whose path contains ``folder/``."""
    return docs.filter(F.col("folder_name").like(f"%{folder}/%"))
