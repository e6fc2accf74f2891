"""Near-duplicates by bottom-k sketches of word shingles from one hash function.

1. Every text gets its shingle set's size and its sketch: the ``SKETCH`` smallest shingle hashes.
   Texts with the same words are one class; classes are compared, not copies.
2. Inverted lists of retained values. A similar pair shares a good part of its retained values, so it
   also shares one of the rarest rest of either; values of one class only never leave the count.
3. Lists longer than ``LONG_LIST`` are not used. A pair found in no shorter one shares long lists only:
   both are classes of mostly common text, and there are few of those. They are compared by inverted
   lists of their full shingle sets, which bound exactly how much a class can share and with what sizes.
4. A list offers its most central class to all others. Once those are linked, only classes outside the
   list's largest component are offered, to classes of sizes they can be similar to and by no more
   values than that pair of sizes asks for, so that a list of n near copies costs about n pairs.
5. Offered pairs are kept when sizes fit and the estimate from the union of both sketches is within
   reach of the threshold, then decided by the exact Jaccard similarity of the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.arrays import Texts, _powers, bounds, mixed, slices, windows
from wardflow.llm.common import bounded_batches, map_texts, release_memory
from wardflow.llm.components import connected
from wardflow.session import materialize

#: Retained values. At 80 % similarity 51 of 64 are shared on average, with a deviation of 3.2.
SKETCH = 64
#: Of those, the smallest ones have inverted lists. A similar pair shares more than this share of them
#: (25.6 of 32 on average, with a deviation of 2.3).
LISTED = 32
SURELY_SHARED = 0.4
#: Pairs estimated below this share (five deviations under 80 %) are not verified.
REACH = 0.55
PERCENT = 80
#: Inverted lists up to this length are read as they are.
LONG_LIST = 64
#: Rounds in which lists offer one class before all pairs left are compared; fewer if those are at most
#: so many times the list entries.
ROUNDS = 3
AT_ONCE = 40
#: Lists of a class, its longest ones, that offer it their central class at first.
LEADING = 4
#: Sizes of one bucket differ by this factor at most.
BUCKET = 1.02


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[np.ndarray, np.uint64]]:
    """Of each text the sorted distinct shingle hashes, and a hash of its whole word sequence.

    Words are runs of characters that are not blank, A-Z as lower case. Fewer words than a shingle
    has are one shingle; without words the set is empty.
    """
    flat = Texts(texts, lower=True)
    owner, start, end = flat.words()
    prints = flat.fingerprints(start, end)
    shingles, first = windows(prints, owner, words)
    cut = bounds(owner, flat.count)
    per_text = bounds(owner[first], flat.count)
    powers = _word_powers(len(prints))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(prints ^ _SALT) * powers[: len(prints)], dtype=np.uint64)])
    for k in range(flat.count):
        a, b = cut[k], cut[k + 1]
        whole = mixed((sums[b : b + 1] - sums[a : a + 1]) * _word_inverses(len(prints))[a : a + 1] + np.uint64(b - a))[0]
        if b - a >= words:
            yield np.unique(shingles[per_text[k] : per_text[k + 1]]), whole
        elif b > a:
            yield np.array([whole]), whole
        else:
            yield np.zeros(0, np.uint64), np.uint64(0)


_SALT = np.uint64(0xA0761D6478BD642F)
_STEP = 0xE7037ED1A0B428DB
_KEPT: dict[str, np.ndarray] = {}


def _grown(name: str, base: int, n: int) -> np.ndarray:
    if name not in _KEPT or len(_KEPT[name]) <= n:
        _KEPT[name] = _powers(np.uint64(base), 2 * n + 1)
    return _KEPT[name]


def _word_powers(n: int) -> np.ndarray:
    return _grown("up", _STEP, n)


def _word_inverses(n: int) -> np.ndarray:
    return _grown("down", pow(_STEP, -1, 1 << 64), n)


def sketches(docs: DataFrame, words: int, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``cls`` (equal for equal word sequences), ``n_shingles`` and ``sketch``."""

    def compute():
        def run(texts: pa.Array) -> dict[str, pa.Array]:
            keys, sizes, kept = [], [], []
            for found, whole in shingle_sets(texts, words):
                sizes.append(len(found))
                kept.append(found[:SKETCH])
                keys.append(f"{int(whole):016x}{int(found[0]) if len(found) else 0:016x}{len(found):x}")
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32)
            values = np.concatenate([*kept, np.zeros(0, np.uint64)]).view(np.int64)
            return {
                "cls": pa.array(keys, pa.string()),
                "n_shingles": pa.array(sizes, pa.int64()),
                "sketch": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            }

        return run

    return map_texts(docs, text_col, "cls string, n_shingles bigint, sketch array<bigint>", compute, keep)


def _sketch_entries(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Entries of the inverted lists of retained values, and the classes of mostly common text.

    Entries: ``value, node, n, reach, alone, after, leading``; a similar class has at most ``reach``
    shingles, ``alone`` is the share of the class that no other has, and of its shared shingles ``after``
    come from this one on in the order of lists, where that is known.
    """
    listed = F.slice("sketch", 1, LISTED)
    held = classes.select("node", "n_shingles", F.size(listed).alias("k"), F.explode(listed).alias("value"))
    lists = held.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    mine = (
        held.join(lists, "value")
        .groupBy("node", "n_shingles", "k")
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"))
    )
    mine = materialize(mine, "near-shared")
    # Values of this class alone are the rarest of its prefix; list lengths say what fills the rest.
    surely = F.ceil(F.col("k") * SURELY_SHARED)
    room = (F.size("shared") - surely + 1).cast("int")
    alone = (1 - F.size("shared") / F.col("k")).alias("alone")
    first = F.filter(F.slice("shared", F.lit(1), room), lambda e: e["df"] <= LONG_LIST)
    listed = mine.filter(room > 0).select("node", F.col("n_shingles").alias("n"), alone, first.alias("first"))
    entries = listed.select("*", F.posexplode("first").alias("at", "e")).select(
        "e.value",
        "node",
        "n",
        (F.col("n") * 100 / percent).alias("reach"),
        "alone",
        F.lit(None).cast("bigint").alias("after"),
        (F.size("first") - F.col("at") <= LEADING).alias("leading"),
    )
    common = F.size(F.filter("shared", lambda e: e["df"] > LONG_LIST))
    return entries, mine.filter(common >= surely).select("node")


def _full_entries(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The same from the full shingle sets of classes of mostly common text.

    Of n shingles m are shared with any of these classes, so a similar one has no more than
    ``m (100 + percent) / percent - n`` shingles, and must have ``percent`` of n. Classes that nothing
    can be similar to are dropped, and of the others' shingles the common ones that the prefix filter
    does not need.
    """
    bounded_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, column in slices(batch, "text"):
                sets = [found for found, _ in shingle_sets(column, words)]
                sizes = np.array([len(found) for found in sets])
                nodes = np.repeat(part.column("node").to_numpy(), sizes)
                values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                arrays = [pa.array(values), pa.array(nodes, pa.int64()), pa.array(np.repeat(sizes, sizes), pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["value", "node", "n"])
        release_memory()

    held = materialize(texts.select("node", "text").mapInArrow(run, "value bigint, node bigint, n bigint"), "near-full")
    lists = held.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    shared = held.join(lists, "value")
    order = W.partitionBy("node").orderBy("df", "value")
    ranked = shared.withColumn("rank", F.row_number().over(order)).withColumn(
        "m", F.count("*").over(W.partitionBy("node"))
    )
    n, m = F.col("n"), F.col("m")
    reach = F.least(m * (100 + percent) / percent - n, n * 100 / percent)
    after = m - F.col("rank") + 1
    needed = F.ceil(n * percent / 100)
    kept = ranked.withColumn("reach", reach).filter((F.col("reach") * 100 >= n * percent) & (after >= needed))
    return kept.select(
        "value", "node", "n", "reach", (1 - m / n).alias("alone"), after.cast("bigint").alias("after"),
        (after - needed < LEADING).alias("leading"),
    )


def _similar_enough(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose sizes fit and whose union sketch does not speak against them."""
    side = classes.select("node", "n_shingles", "sketch")
    both = pairs.join(side.toDF("a", "n_a", "s_a"), "a").join(side.toDF("b", "n_b", "s_b"), "b")
    fits = (F.least("n_a", "n_b") * 100) >= (F.greatest("n_a", "n_b") * percent)
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    common = F.array_intersect(union, F.array_intersect("s_a", "s_b"))
    near = F.size(common) >= F.size(union) * (REACH * percent / PERCENT)
    return both.filter(fits).filter(near).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs of classes with ``100 * intersection >= percent * union`` of the full shingle sets."""
    bounded_batches(pairs.sparkSession)
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, left in slices(batch, "text_a"):
                part = part.append_column("left", left)
                for rows, right in slices(part, "text_b"):
                    links = []
                    first = shingle_sets(rows.column("left"), words)
                    for (x, _), (y, _) in zip(list(first), shingle_sets(right, words)):
                        common = len(x) + len(y) - len(np.union1d(x, y))
                        links.append(100 * common >= percent * (len(x) + len(y) - common))
                    yield rows.select(["a", "b"]).filter(pa.array(links, pa.bool_()))
        release_memory()

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def links(classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links ``a, b`` between classes, enough to connect every similar pair: they leave no pair that
    shares a list and can be similar undecided and in different components.

    ``classes``: node, n_shingles, sketch and ``first`` (doc_id, print), which finds their text in
    ``docs`` (doc_id, print, text).
    """
    entries, common = _sketch_entries(classes, percent)
    entries = materialize(entries, "near-entries")
    wanted = entries.select("node").unionByName(common).distinct()
    places = classes.join(wanted, "node", "left_semi").select(
        "node", F.col("first.doc_id").alias("place"), F.col("first.print").alias("print")
    )
    texts = docs.join(places, (docs["print"] == places["print"]) & docs["doc_id"].eqNullSafe(places["place"]))
    texts = materialize(texts.select("node", "text"), "near-texts")
    full = _full_entries(texts.join(common, "node", "left_semi"), words, percent)
    # A value listed in both ways is two lists.
    entries = entries.withColumn("value", F.xxhash64("value")).unionByName(full)
    entries = materialize(entries, "near-entries")
    size = entries.count()

    def decide(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        near = materialize(_similar_enough(pairs, classes, percent), "near-offered")
        return near, materialize(_verified(near, texts, words, percent), "near-links")

    tested, found = decide(_offered_by_one(entries, entries))
    for left in reversed(range(ROUNDS)):
        outside, named = _outside(entries, connected(found))
        offers, count = _fitting(outside, named, percent)
        if count == 0:
            break
        last = left == 0 or count <= AT_ONCE * max(size, 1000)
        pairs = _unordered(offers) if last else _offered_by_one(outside, entries)
        near, new = decide(pairs.join(tested, ["a", "b"], "left_anti"))
        tested, found = tested.unionByName(near), found.unionByName(new)
        if last:
            break
    return found


def _unordered(pairs: DataFrame) -> DataFrame:
    """Pairs ``x, y`` as ``a < b``, each once."""
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _offered_by_one(some: DataFrame, entries: DataFrame) -> DataFrame:
    """The most central class of each list in ``some`` with every other class of the list."""
    best = some.groupBy("value").agg(F.min(F.struct("alone", "node")).alias("best"))
    pairs = entries.filter("leading").join(best, "value").select(F.col("node").alias("x"), F.col("best.node").alias("y"))
    return _unordered(pairs.filter("x <> y"))


def _outside(entries: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries outside the largest component of their list, and all entries of those lists with labels."""
    labels = labels.select(F.col("node").alias("known"), "label")
    named = entries.join(labels, F.col("node") == F.col("known"), "left")
    named = named.withColumn("label", F.coalesce("label", "node")).drop("known")
    parts = named.groupBy("value", "label").agg(F.count("*").alias("held"))
    largest = parts.groupBy("value").agg(
        F.max(F.struct("held", "label")).alias("most"), F.count("*").alias("parts")
    )
    largest = largest.filter("parts > 1").select("value", F.col("most.label").alias("main"))
    named = materialize(named.join(largest, "value"), "near-open")
    return named.filter("label <> main"), named


def _fitting(outside: DataFrame, named: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """Pairs ``x, y`` of entries outside and entries of their list in another component and of sizes that
    both can be similar to; and how many are compared for that, from counts per size bucket."""

    def bucket(size):
        return F.floor(F.log(F.greatest(size, F.lit(1.0))) / F.log(F.lit(BUCKET))).cast("int")

    low, high = bucket(F.col("n") * (percent / 100)), bucket(F.col("reach"))
    x = outside.filter(high >= low).select(
        "value", F.col("node").alias("x"), F.col("n").alias("x_n"), F.col("reach").alias("x_reach"),
        F.col("label").alias("x_label"), F.col("after").alias("x_after"),
        F.explode(F.sequence(low, high)).alias("bucket"),
    )
    y = named.select(
        "value", F.col("node").alias("y"), F.col("n").alias("y_n"), F.col("reach").alias("y_reach"),
        F.col("label").alias("y_label"), F.col("after").alias("y_after"), bucket(F.col("n")).alias("bucket"),
    )
    key = ["value", "bucket"]
    sizes = x.groupBy(key).agg(F.count("*").alias("n_x")).join(y.groupBy(key).agg(F.count("*").alias("n_y")), key)
    count = sizes.agg(F.sum(F.col("n_x") * F.col("n_y")).alias("pairs")).first()["pairs"] or 0
    within = (F.col("y_n") <= F.col("x_reach") + 1e-9) & (F.col("x_n") <= F.col("y_reach") + 1e-9)
    fits = within & (F.col("x_label") != F.col("y_label"))
    # If this is the first value that both hold, all they share comes from here on.
    shared = F.ceil((F.col("x_n") + F.col("y_n")) * (percent / (100 + percent)) - 1e-9)
    fits = fits & (F.coalesce(F.least("x_after", "y_after"), shared) >= shared)
    return x.join(y, key).filter(fits).select("x", "y"), count


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id that links
    reach) and ``kept`` (the id is the component's); ``print`` is the text's hash, to tell rows with one
    id apart.

    Texts without words (null, empty, blank) have 0 shingles and link with nothing: each is its own
    component. A null id is only the component's if no other is in it. Repeated rows come back as often
    as they came. Other columns are not read.
    """
    source = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("print"),
        F.col(f"`{text_col}`").alias("text"),
    )
    rows = materialize(sketches(source, words, keep=["doc_id", "print"]), "near-rows")
    full = rows.filter("n_shingles > 0")
    first = full.groupBy("cls").agg(
        F.min(F.struct("doc_id", "print")).alias("first"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("sketch").alias("sketch"),
    )
    # The numbers are fixed by writing them.
    classes = materialize(first.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    labels = connected(links(classes, source, words, percent))
    labels = labels.select(F.col("node").alias("known"), "label")
    named = classes.select("cls", "node").join(labels, F.col("node") == F.col("known"), "left")
    named = named.select("cls", F.coalesce("label", "node").alias("label"))
    placed = materialize(
        rows.select("doc_id", "print", "n_shingles", "cls").join(named, "cls", "left"), "near-placed"
    )
    lowest = placed.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("lowest"))
    found = placed.join(lowest, "label", "left")
    component = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "print",
    )
