"""Language identification by nearest centroid.

A text is a vector of hashed byte n-grams (1 to 3 bytes of lower-cased text, marks and digits as
blanks), weighted by TF-IDF and brought to length one. Every language has several centroids, found by
spherical k-means among its own training texts, so that kinds of text within a language keep apart.
A text takes the language of the centroid with the greatest cosine. How near texts of a language come to
their centroids depends on their length, so beginnings of the training texts are measured as well; a text
further off than they let expect of its length is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.arrays import LOWER, Texts
from wardflow.llm.common import bounded_batches, map_texts
from wardflow.session import materialize

UNDETERMINED = "und"
DIMENSIONS = 4096
#: The classifier is fitted on at most so many labelled texts of each language, those whose text hashes lowest.
SAMPLE_PER_LANGUAGE = 1000
CENTROIDS = 4
STEPS = 12
#: Centroids that stand for fewer training texts are given up.
LEAST_TEXTS = 20
#: Bytes of the beginnings that are measured; whole texts are measured too.
LENGTHS = (8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096)
#: The floor for a length lies below the median cosine by so many times what the low quantile does, and by
#: some more, as longer texts than those measured and texts in capitals are a little further off.
QUANTILE, REACH, SLACK = 0.1, 3.0, 0.18

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[:] = _FOLD[LOWER]


def counts(texts: pa.Array) -> np.ndarray:
    """Hashed n-gram counts, one row per text; n-grams stay within a text."""
    flat = Texts(texts)
    data = _FOLD[flat.data].astype(np.uint32)
    owner = np.repeat(np.arange(flat.count), np.diff(flat.starts))
    total = np.zeros(flat.count * DIMENSIONS, np.float64)
    code = np.zeros(len(data), np.uint32)
    for width in (1, 2, 3):
        usable = len(data) - width + 1
        if usable <= 0:
            break
        code = code[:usable] << np.uint32(8) | data[width - 1 :]
        inside = owner[:usable] == owner[width - 1 :]
        slot = (code * np.uint32(2654435761) + np.uint32(width)) >> np.uint32(20)
        places = owner[:usable][inside] * DIMENSIONS + slot[inside]
        total += np.bincount(places, minlength=len(total))
    return total.reshape(flat.count, DIMENSIONS)


def has_letter(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)


def weighted(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(raw) * idf
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.maximum(length, 1e-12)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]  # of every centroid
    idf: np.ndarray
    centroids: np.ndarray
    floors: np.ndarray  # of every centroid's language: the least cosine at each of ``LENGTHS``

    def predict(self, texts: pa.Array, sizes: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected. Score: the cosine, at least 0."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosines = weighted(counts(texts), self.idf) @ self.centroids.T
        best = cosines.argmax(axis=1)
        score = cosines[np.arange(len(best)), best]
        rejected = score < self.floor(best, sizes)
        silent = ~has_letter(texts)
        names = np.array(self.languages, dtype=object)[best]
        names[silent] = UNDETERMINED
        score = np.clip(np.where(silent, 0.0, score), 0.0, 1.0)
        return names.tolist(), score, rejected | silent

    def floor(self, centroid: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The least cosine for texts of these sizes, between lengths by the length's logarithm."""
        place = np.log2(np.clip(sizes, LENGTHS[0], LENGTHS[-1])) - np.log2(LENGTHS[0])
        step = np.minimum(place.astype(int), len(LENGTHS) - 2)
        low, high = self.floors[centroid, step], self.floors[centroid, step + 1]
        return low + (high - low) * (place - step)


def _kmeans(vectors: np.ndarray, k: int, least: int = LEAST_TEXTS) -> np.ndarray:
    """Centroids of length one; the start is spread out, not random. Small clusters are given up and
    their texts go to the others, as long as there are others."""
    chosen = [int((vectors @ vectors.mean(axis=0)).argmax())]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int((vectors @ vectors[chosen].T).max(axis=1).argmin()))
    centroids = vectors[chosen]
    while True:
        for _ in range(STEPS):
            cluster = (vectors @ centroids.T).argmax(axis=1)
            sums = np.stack([vectors[cluster == j].sum(axis=0) if (cluster == j).any() else c for j, c in enumerate(centroids)])
            centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        sizes = np.bincount((vectors @ centroids.T).argmax(axis=1), minlength=len(centroids))
        if len(centroids) == 1 or sizes.min() >= least:
            return centroids
        centroids = np.delete(centroids, sizes.argmin(), axis=0)


def _beginning(text: bytes, size: int) -> bytes:
    """So many bytes, less what remains of a character at the end."""
    part = text[:size]
    while part and len(part) < len(text) and text[len(part)] & 0xC0 == 0x80:
        part = part[:-1]
    return part


def _floors(texts: pa.Array, idf: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each of ``LENGTHS`` the least usual cosine of texts of that length.

    Each length takes the texts' beginnings of it, the last also longer texts as they are. A length
    that fewer than ``LEAST_TEXTS`` texts have takes the next shorter one's floor.
    """
    raw = [t.encode() for t in texts.to_pylist()]
    found, last = [], -1.0
    for size in LENGTHS:
        parts = [_beginning(t, size).decode() for t in raw if len(t) >= size]
        if len(parts) >= LEAST_TEXTS:
            near = np.concatenate(
                [
                    (weighted(counts(pa.array(parts[k : k + 256], pa.large_string())), idf) @ centroids.T).max(axis=1)
                    for k in range(0, len(parts), 256)
                ]
            )
            middle, low = np.quantile(near, [0.5, QUANTILE])
            last = middle - REACH * (middle - low) - SLACK
        found.append(last)
    return np.maximum.accumulate(found)


def training_sample(labelled: DataFrame) -> DataFrame:
    """At most ``SAMPLE_PER_LANGUAGE`` rows of each language, those whose text hashes lowest.

    The languages' sizes (one row each, as in the model itself) say below which hash about twice as
    many rows as needed lie; only those are ranked, however many rows or map tasks there are.
    """
    sizes = labelled.groupBy(F.col("lang").alias("sized")).agg(F.count("*").alias("n"))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    near = labelled.withColumn("place", place).join(
        F.broadcast(sizes),
        (F.col("lang") == F.col("sized"))
        & (F.col("place") < F.lit(float(1 << 40)) * (2.0 * SAMPLE_PER_LANGUAGE) / F.col("n")),
    )
    order = W.partitionBy("lang").orderBy("place", "text")
    ranked = near.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= SAMPLE_PER_LANGUAGE).select("lang", "text")


def fit(labelled: DataFrame) -> Model:
    """The model of ``lang, text`` rows without nulls, fitted on the bounded sample.

    Each language's sample is one group of at most ``SAMPLE_PER_LANGUAGE`` texts: one pass counts in how
    many texts a slot occurs, the next finds the language's centroids and floors. Only these sums and
    centroids, a few rows of ``DIMENSIONS`` numbers per language, come to the driver.
    """
    spark = labelled.sparkSession
    bounded_batches(spark)
    sample = materialize(training_sample(labelled), "language-sample")

    def slots(table: pa.Table) -> pa.Table:
        held = sum(((raw > 0).sum(axis=0) for raw, _ in _counted(table)), np.zeros(DIMENSIONS, np.int64))
        return pa.table([[table.num_rows], [held.astype(np.int64).tobytes()]], names=["n", "held"])

    sums = sample.groupBy("lang").applyInArrow(slots, "n long, held binary").collect()
    if not sums:
        return Model((), np.zeros(DIMENSIONS), np.zeros((0, DIMENSIONS)), np.zeros((0, len(LENGTHS))))
    held = sum(np.frombuffer(r["held"], np.int64) for r in sums)
    idf = np.log((1 + sum(r["n"] for r in sums)) / (1 + held)) + 1

    def clusters(table: pa.Table) -> pa.Table:
        # In the same order whatever order the rows come in.
        table = table.sort_by("text")
        vectors = np.concatenate([weighted(raw, idf).astype(np.float32) for raw, _ in _counted(table)])
        centroids = _kmeans(vectors, CENTROIDS).astype(np.float64)
        floors = _floors(table.column("text").cast(pa.large_string()), idf, centroids)
        names = [table.column("lang")[0].as_py()] * len(centroids)
        return pa.table([names, [c.tobytes() for c in centroids], [floors.tobytes()] * len(centroids)], names=["lang", "centroid", "floors"])

    rows = sample.groupBy("lang").applyInArrow(clusters, "lang string, centroid binary, floors binary").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["centroid"])))
    return Model(
        tuple(r["lang"] for r in rows),
        idf,
        np.array([np.frombuffer(r["centroid"]) for r in rows]),
        np.array([np.frombuffer(r["floors"]) for r in rows]),
    )


def _counted(table: pa.Table):
    """Counts and texts of some rows at a time: their count matrix is 32 KB each."""
    texts = table.column("text").combine_chunks().cast(pa.large_string())
    for at in range(0, len(texts), 128):
        part = texts.slice(at, 128)
        yield counts(part), part


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected``, from whole texts.

    Texts without a letter (null, empty, marks) are ``und`` with score 0, rejected. All columns and
    repeated rows stay; columns with the three names are replaced. No row leaves its partition.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute():
        def run(texts: pa.Array) -> dict[str, pa.Array]:
            sizes = np.diff(Texts(texts).starts)
            names, score, rejected = [], [], []
            # A few hundred texts at a time: their count matrix is 32 KB each.
            for at in range(0, len(texts), 256):
                part = texts.slice(at, 256)
                a, b, c = shared.value.predict(part, sizes[at : at + 256])
                names += a
                score.append(b)
                rejected.append(c)
            return {
                "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(np.concatenate(score), pa.float64()),
                "rejected": pa.array(np.concatenate(rejected), pa.bool_()),
            }

        return run

    return map_texts(docs, text_col, "lang_pred string, score double, rejected boolean", compute, keep)


def labelled_rows(docs: DataFrame, wanted=None) -> DataFrame:
    """``lang, text`` of rows that have both and meet ``wanted``."""
    rows = docs if wanted is None else docs.filter(wanted)
    return rows.select(F.col("lang").cast("string"), F.col("text").cast("string")).dropna()
