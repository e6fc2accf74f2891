"""Hard negatives: for every anchor and positive the best rows of another label in a window of scores.

Rows are packed into tiles of anchors and tiles of candidates. Every pair of tiles is one integer
matrix product; of it only bounded heaps leave the task: first each anchor's best rows of its own
label, then, once these are known, for each of them the best rows of other labels in its window.
Heaps of the same anchor are merged, inside a task as pairs go by and over all tasks by rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches
from wardflow.llm.strassen import product
from wardflow.session import materialize

ANCHOR_ROWS, CANDIDATE_ROWS = 512, 2048

#: Stands below every score.
LEAST = np.iinfo(np.int64).min

TILE = "tile int, n int, width int, ids binary, known binary, rows binary, labels binary, cells binary"
HEAP = "anchor_row long, place int, other_row long, other_id long, score long"


def mine(
    table: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """Per anchor and positive up to ``negatives`` rows of another label.

    A row's vector is ``floor(256 * x)`` of its components and its score the integer inner product
    with the anchor. An anchor's positives are its ``positives`` best other rows of the same label; a
    negative's score lies between ``low`` and ``high`` hundredths of the positive's. Higher scores come
    first, then smaller ids.

    ``is_anchor`` and the three columns are columns of ``table``, the label a whole number; any further
    columns may have any names. Rows with a null label, vector or component, or with a component that
    is not finite, take no part. Rows without an id take part and come after all others of the same
    score; an anchor flag of null is no. Repeated rows are rows of their own: a copy of an anchor is one
    of its other rows. Shorter vectors count as padded with zeros. A score beyond 64 bits raises. No
    rows, no anchors or a single label give no rows.
    """
    spark = table.sparkSession
    bounded_batches(spark)
    rows = materialize(_taking_part(table, is_anchor, id_col, vector_col, label_col), "vectors")
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors")).first()
    n_anchor = max(1, ceil(sizes["anchors"] / ANCHOR_ROWS))
    n_other = max(1, ceil(sizes["n"] / CANDIDATE_ROWS))
    anchors = materialize(_tiles(rows.filter("anchor"), n_anchor), "anchor-tiles")
    others = materialize(_tiles(rows, n_other), "candidate-tiles")

    best = _pairs(anchors, others, n_anchor, n_other).mapInArrow(_positive_heaps(positives), HEAP)
    best = _merged(best, positives)
    chosen = materialize(
        best.join(rows.filter("anchor").select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id")), "anchor_row")
        .withColumn("tile", _tile(F.col("anchor_row"), n_anchor)),
        "positives",
    )
    wanted = chosen.groupBy("tile").agg(
        F.collect_list("anchor_row").alias("w_anchor"), F.collect_list("place").alias("w_place"), F.collect_list("score").alias("w_score")
    )
    windows = _pairs(anchors.join(wanted, "tile"), others, n_anchor, n_other)
    found = _merged(windows.mapInArrow(_window_heaps(negatives, low, high), HEAP), negatives, by=("anchor_row", "place"))
    positive = chosen.select(
        "anchor_row", "anchor_id", F.col("other_id").alias("positive_id"), F.col("other_row").alias("positive_row"),
        F.col("score").alias("positive_score"), "place",
    )
    return found.join(positive, ["anchor_row", "place"]).select(
        "anchor_id",
        "positive_id",
        F.col("best").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _taking_part(table: DataFrame, is_anchor: Column, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    def sound(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    vector = F.col(f"`{vector_col}`").cast("array<double>")
    return table.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        vector.alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", sound))


def _tile(row: Column, tiles: int) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(tiles)).cast("int")


def _tiles(rows: DataFrame, tiles: int) -> DataFrame:
    """Rows dealt by their numbers' hashes, each tile one packed matrix with its rows in order of id."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("id").combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        id_values = ids.fill_null(0).to_numpy()
        row_values, labels = table.column("row").to_numpy(), table.column("label").to_numpy()
        vectors = table.column("vector").combine_chunks()
        lengths = vectors.value_lengths().to_numpy()
        width = int(lengths.max(initial=0))
        cells = np.zeros((len(lengths), width))
        cells[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy()
        cells = np.floor(256 * cells)
        if cells.size and np.abs(cells).max() >= 2.0**62:
            raise OverflowError("a component does not fit in 64 bits")
        order = np.lexsort((row_values, id_values, ~known))
        packed = [id_values, known, row_values, labels, cells.astype(np.int64)]
        values = [table.column("tile")[0].as_py(), len(order), width, *(x[order].tobytes() for x in packed)]
        return pa.table([[v] for v in values], schema=_TILE_SCHEMA)

    return rows.withColumn("tile", _tile(F.col("row"), tiles)).groupBy("tile").applyInArrow(pack, TILE)


_TILE_SCHEMA = pa.schema(
    [("tile", pa.int32()), ("n", pa.int32()), ("width", pa.int32()), *((c, pa.binary()) for c in ("ids", "known", "rows", "labels", "cells"))]
)


def _pairs(anchors: DataFrame, others: DataFrame, n_anchor: int, n_other: int) -> DataFrame:
    """Every tile of anchors with every tile of candidates, each pair under a key of its own.

    The sides' sizes on disk do not tell how often their tiles are repeated here, so neither may be
    broadcast by them.
    """
    left = anchors.withColumnRenamed("tile", "a").withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
    right = others.select(F.col("tile").alias("c"), *[F.col(x).alias(f"c_{x}") for x in others.columns if x != "tile"])
    right = right.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(n_anchor - 1))))
    return left.hint("merge").join(right, ["a", "c"])


class _Side:
    """One tile, unpacked; ``prefix`` tells the two sides of a pair apart."""

    def __init__(self, row: dict, prefix: str = ""):
        width = row[prefix + "width"]
        self.ids, self.rows, self.labels, cells = (
            np.frombuffer(row[prefix + x], np.int64) for x in ("ids", "rows", "labels", "cells")
        )
        self.known = np.frombuffer(row[prefix + "known"], bool)
        self.cells = cells.reshape(-1, width) if width else np.zeros((len(self.ids), 0), np.int64)


def _scores(a: _Side, c: _Side) -> np.ndarray:
    width = max(a.cells.shape[1], c.cells.shape[1])
    wide = [np.pad(x.cells, ((0, 0), (0, width - x.cells.shape[1]))) for x in (a, c)]
    return product(wide[0], np.ascontiguousarray(wide[1].T))


def _take_best(scores: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Up to ``k`` times: lines that still have an allowed place, and the best of them; the first of equals."""
    left = np.where(allowed, scores, LEAST)
    lines = np.arange(len(left))
    if not left.shape[1]:
        return
    for _ in range(k):
        best = left.argmax(axis=1)
        have = allowed[lines, best]
        if not have.any():
            return
        yield lines[have], best[have]
        left[lines, best] = LEAST
        allowed = allowed & (np.arange(left.shape[1]) != best[:, None])


def _heap(anchor_rows: np.ndarray, place: np.ndarray, c: _Side, at: np.ndarray, scores: np.ndarray) -> pa.Table:
    ids = pa.array(c.ids[at], pa.int64(), mask=~c.known[at])
    return pa.table([anchor_rows, place.astype(np.int32), c.rows[at], ids, scores], schema=_HEAP_SCHEMA)


_HEAP_SCHEMA = pa.schema(
    [("anchor_row", pa.int64()), ("place", pa.int32()), ("other_row", pa.int64()), ("other_id", pa.int64()), ("score", pa.int64())]
)


def merge_heaps(heaps: list[pa.Table], k: int) -> pa.Table:
    """The best ``k`` of each anchor and place over several heaps."""
    both = pa.concat_tables(heaps).combine_chunks()
    anchor, place, row, score = (both.column(x).to_numpy() for x in ("anchor_row", "place", "other_row", "score"))
    ids = both.column("other_id").combine_chunks()
    missing, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    order = np.lexsort((row, ids, missing, ~score, place, anchor))
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(anchor[order]) != 0) | (np.diff(place[order]) != 0)
    begins = np.flatnonzero(first)
    nth = np.arange(len(order)) - np.repeat(begins, np.diff([*begins, len(order)]))
    return both.take(order[nth < k])


def _over_pairs(of_pair, k: int):
    """A function for mapInArrow that merges the heaps of successive pairs of one anchor tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n].as_py() for name in batch.schema.names}
                if held and row["a"] != tile:
                    yield from merge_heaps(held, k).to_batches()
                    held = []
                tile = row["a"]
                held.extend(of_pair(row))
                if len(held) > 1:
                    held = [merge_heaps(held, k)]
        if held:
            yield from merge_heaps(held, k).to_batches()

    return run


def _positive_heaps(k: int):
    def of_pair(row: dict) -> Iterator[pa.Table]:
        a, c = _Side(row), _Side(row, "c_")
        scores = _scores(a, c)
        allowed = (a.labels[:, None] == c.labels) & (a.rows[:, None] != c.rows)
        for lines, at in _take_best(scores, allowed, k):
            yield _heap(a.rows[lines], np.zeros(len(lines)), c, at, scores[lines, at])

    return _over_pairs(of_pair, k)


def _window_heaps(k: int, low: int, high: int):
    def of_pair(row: dict) -> Iterator[pa.Table]:
        a, c = _Side(row), _Side(row, "c_")
        scores = _scores(a, c)
        other = a.labels[:, None] != c.labels
        anchor, place, wanted = (np.array(row["w_" + x], np.int64) for x in ("anchor", "place", "score"))
        line = np.argsort(a.rows)[np.searchsorted(np.sort(a.rows), anchor)]
        # 100 * s between low * p and high * p, as bounds on whole numbers s; Python's integers do not overflow.
        least = np.array([-(-low * int(p) // 100) for p in wanted], np.int64)
        most = np.array([high * int(p) // 100 for p in wanted], np.int64)
        for nth in np.unique(place):
            here = np.flatnonzero(place == nth)
            part = scores[line[here]]
            allowed = other[line[here]] & (part >= least[here, None]) & (part <= most[here, None])
            for lines, at in _take_best(part, allowed, k):
                yield _heap(anchor[here[lines]], np.full(len(lines), nth), c, at, part[lines, at])

    return _over_pairs(of_pair, k)


def _merged(heaps: DataFrame, k: int, by: tuple[str, ...] = ("anchor_row",)) -> DataFrame:
    """The best ``k`` over all tasks; for positives their rank becomes ``place``, otherwise it is ``best``."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other_row")
    name = "place" if len(by) == 1 else "best"
    return heaps.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


#: Brute force: all scores of all anchors.
SQL = """
WITH sound AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, o.r, o.vec_id, a.label = o.label AS same,
    CAST(list_dot_product(a.q, o.q) AS BIGINT) AS score
  FROM sound a JOIN sound o ON a.r <> o.r
  WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, r) <= 5),
negative AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
    n.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.r ORDER BY n.score DESC, n.vec_id NULLS LAST, n.r) AS rank
  FROM positive p JOIN scored n ON n.ar = p.ar AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= 3
"""
