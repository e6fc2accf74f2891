"""Token ids of documents as compressed files in ascending order of document, and reading them back.

A file row is a shard: some millions of ids of consecutive documents, compressed by a Re-Pair grammar
of their own (``repair``). The shards of a file are in order, and so are the files: documents are
parted by ranges of their id. Sizes in ids and in symbols are kept per document, so that any document
is decoded from its shard's rules and its own symbols.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.arrays import slices
from wardflow.llm.bpe import Vocabulary
from wardflow.llm.common import bounded_batches
from wardflow.llm.presplit import PieceCoder, Pieces
from wardflow.llm.repair import Grammar, compress

#: Ids after which a shard is closed (with the document they end in).
SHARD_IDS = 3_000_000
END_ID = 2
#: New words that the library gets in one text.
TOGETHER = 500
#: Pieces a worker remembers before it starts over.
PIECES = 800_000

FILE_SCHEMA = (
    "part int, seq int, base int, doc_ids array<bigint>, sizes array<int>, symbol_counts array<int>, "
    "symbols binary, rule_left binary, rule_right binary, rule_length binary"
)


class ByteLevelEncoder:
    """Whole texts to ids with the library; every distinct piece is given to it once."""

    def __init__(self, vocabulary: Vocabulary):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary.source)
        self.library.no_truncation()
        self.library.no_padding()
        self.coder = PieceCoder(self._encode, PIECES)
        self.specials = list(vocabulary.specials)
        # In a byte-level vocabulary the length of a token's name is its length in bytes.
        self.lengths = np.array([len(name) for name in vocabulary.labels()])

    def _encode(self, strings: list[str]) -> list[list[int]]:
        """Blank-led words are given to the library as running text, which it cuts into the same pieces;
        the ids are shared out by their bytes. All other pieces go one by one."""
        found: list[list[int] | None] = [None] * len(strings)
        worded = [k for k, s in enumerate(strings) if s[0] == " " and s[1:].isalpha()]
        for at in range(0, len(worded), TOGETHER):
            part = worded[at : at + TOGETHER]
            whole = "".join(strings[k] for k in part)
            ids = self.library.encode_batch_fast([whole], add_special_tokens=False)[0].ids
            upto = np.concatenate([[0], np.cumsum(self.lengths[ids])])
            ends = np.cumsum([len(strings[k].encode()) for k in part])
            cuts = [0, *np.searchsorted(upto, ends).tolist()]
            for k, a, b in zip(part, cuts, cuts[1:]):
                found[k] = ids[a:b]
        others = [k for k, ids in enumerate(found) if ids is None]
        for k, e in zip(others, self.library.encode_batch_fast([strings[k] for k in others], add_special_tokens=False)):
            found[k] = e.ids
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        strings = texts.to_pylist()
        pieces = Pieces(strings)
        ids, sizes = self.coder.code(pieces, *pieces.byte_level())
        unusual = set(pieces.unsettled.tolist())
        unusual.update(k for k, t in enumerate(strings) if any(s in t for s in self.specials))
        if unusual:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for k in unusual:
                whole = self.library.encode(strings[k], add_special_tokens=False).ids
                parts[k] = np.asarray(whole, np.int32)
                sizes[k] = len(parts[k])
            ids = np.concatenate(parts)
        return ids, sizes


@lru_cache(maxsize=1)
def kept_encoder(source: str) -> ByteLevelEncoder:
    """The encoder of a tokenizer file; a worker's next task goes on with it and with the pieces it knows."""
    return ByteLevelEncoder(Vocabulary.parse(source))


def write_ids(
    docs: DataFrame,
    vocabulary: Vocabulary,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> None:
    """Encode whole texts, add ``end_id`` to each and write shards below ``path``.

    Null and empty texts give the end id alone. Documents without an id come first; equal ids are
    ordered by their text's hash. Only id and text are read. One range shuffle moves every text once;
    a task sorts its range by id and holds one open shard.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary.source)
    base = max(*vocabulary.tokens.values(), *vocabulary.specials.values(), end_id) + 1
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(shared.value)
        part, seq = TaskContext.get().partitionId(), 0
        open_ids: list[np.ndarray] = []
        open_sizes: list[np.ndarray] = []
        names: list[pa.Array] = []
        held = 0
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                ids, sizes = encoder(texts)
                ends = np.cumsum(sizes)
                open_ids.append(np.insert(ids, ends, end_id))
                open_sizes.append(sizes + 1)
                names.append(rows.column(0))
                held += len(open_ids[-1])
                if held >= SHARD_IDS:
                    yield _shard(part, seq, base, names, open_ids, open_sizes)
                    seq, held = seq + 1, 0
                    open_ids, open_sizes, names = [], [], []
        if names:
            yield _shard(part, seq, base, names, open_ids, open_sizes)

    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)


def _shard(part, seq, base, names, ids, sizes) -> pa.RecordBatch:
    all_sizes = np.concatenate(sizes)
    symbols, counts, grammar = compress(np.concatenate(ids), all_sizes, base)
    doc_ids = pa.chunked_array(names, pa.int64()).combine_chunks()

    def whole(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    columns = [
        pa.array([part], pa.int32()),
        pa.array([seq], pa.int32()),
        pa.array([base], pa.int32()),
        whole(doc_ids),
        whole(pa.array(all_sizes, pa.int32())),
        whole(pa.array(counts, pa.int32())),
        pa.array([symbols.astype("<u2").tobytes()], pa.binary()),
        pa.array([grammar.left.astype("<u2").tobytes()], pa.binary()),
        pa.array([grammar.right.astype("<u2").tobytes()], pa.binary()),
        pa.array([grammar.length.astype("<i4").tobytes()], pa.binary()),
    ]
    fields = [f.split()[0] for f in FILE_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names=fields)


def _grammar(row: dict) -> Grammar:
    return Grammar(
        row["base"],
        np.frombuffer(row["rule_left"], "<u2"),
        np.frombuffer(row["rule_right"], "<u2"),
        np.frombuffer(row["rule_length"], "<i4"),
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The shards as they are stored."""
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def read_ids(files: DataFrame, digest: bool = False) -> DataFrame:
    """One row per document: ``part``, ``seq``, ``place`` in the shard, ``doc_id``, ``before`` (ids of the
    shard ahead of it), ``n_tokens`` and ``ids`` or, with ``digest``, ``ids_crc32``."""
    schema = "part int, seq int, place int, doc_id bigint, before bigint, n_tokens bigint, "
    schema += "ids_crc32 bigint" if digest else "ids array<int>"
    files.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in batch.schema.names if n not in ("doc_ids", "sizes", "symbol_counts")}
                doc_ids = batch.column("doc_ids")[k].values
                counts = batch.column("symbol_counts")[k].values.to_numpy()
                symbols = np.frombuffer(row["symbols"], "<u2")
                ids, per_symbol = _grammar(row).expand(symbols)
                upto = np.concatenate([[0], np.cumsum(per_symbol)])[np.concatenate([[0], np.cumsum(counts)])]
                n = len(doc_ids)
                data = ids.astype("<u4")
                if digest:
                    view = memoryview(data).cast("B")
                    cuts = (upto * 4).tolist()
                    last = pa.array([zlib.crc32(view[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["part"]), pa.int32()),
                        pa.array(np.full(n, row["seq"]), pa.int32()),
                        pa.array(np.arange(n), pa.int32()),
                        doc_ids,
                        pa.array(upto[:-1], pa.int64()),
                        pa.array(np.diff(upto), pa.int64()),
                        last,
                    ],
                    names=["part", "seq", "place", "doc_id", "before", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    return files.mapInArrow(run, schema)


def shard_starts(files: DataFrame) -> DataFrame:
    """``part``, ``seq`` and ``shard_start``: the ids of all shards ahead. One row per shard, and the
    unpartitioned sum is over one row per file only."""
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    shards = files.select("part", "seq", size.alias("n"))
    parts = shards.groupBy("part").agg(F.sum("n").alias("n"))
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("part_start"))
    within = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    shards = shards.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return shards.join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.col("inner")).alias("shard_start")
    )


def read_document(files: DataFrame, doc_id: int) -> DataFrame:
    """The ids of one document: only its shard is opened, only its own symbols are expanded."""
    wanted = files.filter(F.array_contains("doc_ids", F.lit(doc_id).cast("long")))
    at = F.array_position("doc_ids", F.lit(doc_id).cast("long")).cast("int")
    ahead = F.aggregate(F.slice("symbol_counts", F.lit(1), at - 1), F.lit(0), lambda a, b: a + b)
    own = F.element_at("symbol_counts", at)
    alone = wanted.select(
        "part", "seq", "base",
        F.slice("doc_ids", at, 1).alias("doc_ids"),
        F.slice("sizes", at, 1).alias("sizes"),
        F.slice("symbol_counts", at, 1).alias("symbol_counts"),
        F.substring("symbols", ahead * 2 + 1, own * 2).alias("symbols"),
        "rule_left", "rule_right", "rule_length",
    )
    return read_ids(alone).select("doc_id", "ids")
