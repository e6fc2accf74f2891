"""Messages that carry one CSV line each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "corrupt_message"
UNDECODABLE = "message"
#: Where a message stood, as far as its source tells.
PLACE = ("topic", "partition", "offset", "file_name")


def message_stream(
    spark: SparkSession, options: dict[str, str], fmt: str = "kafka"
) -> DataFrame:
    """A stream of messages with a text column ``value``, read from the earliest position.

    For Kafka give ``kafka.bootstrap.servers``, ``subscribe`` and, to bound a micro-batch,
    ``maxOffsetsPerTrigger``. Any other format with a ``value`` column will do.
    """
    defaults = {"startingOffsets": "earliest"} if fmt == "kafka" else {}
    source = spark.readStream.format(fmt).options(**{**defaults, **options})
    if fmt == "text":
        return source.load()
    return source.load().withColumn("value", F.col("value").cast("string"))


def decode_messages(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of the CSV line in ``value``.

    A cell that does not fit its type becomes null and the whole line is kept in
    ``corrupt_message``, which is null for good lines.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_csv(
        F.col("value"),
        _ddl(with_corrupt),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'},
    )
    # The one-element explode keeps later filters from parsing the line again.
    return df.select(*keep, F.explode(F.array(parsed)).alias("_row")).select(*keep, "_row.*")


def set_undecodable_apart(messages: DataFrame) -> DataFrame:
    """Messages with ``message``: the bytes of a ``value`` that is not UTF-8, whose text is then null."""
    broken = ~F.coalesce(F.is_valid_utf8("value"), F.lit(True))
    marked = messages.withColumn(UNDECODABLE, F.when(broken, F.col("value").cast("binary")))
    return marked.withColumn("value", F.when(~broken, F.col("value")))


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded rows without the corrupt marker, and the lines that did not decode."""
    good = decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, decoded.filter(F.col(CORRUPT).isNotNull())


def encode_messages(
    df: DataFrame, quoted: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """One CSV line per row in ``value``, next to the columns in ``keep``, which are not part of it.

    Columns in ``quoted`` are always quoted, the others only where the text needs it.
    """
    special = '[",\\n\\r]'

    def cell(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        else:
            text = value.cast("string")
        text = F.coalesce(text, F.lit(""))
        in_quotes = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        if field.name in quoted:
            return in_quotes
        if isinstance(field.dataType, T.StringType):
            return F.when(text.rlike(special), in_quotes).otherwise(text)
        return text

    cells = [cell(f) for f in df.schema if f.name not in keep]
    return df.select(*keep, F.concat_ws(",", *cells).alias("value"))


def header_line(schema: T.StructType) -> str:
    return ",".join(schema.names)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
