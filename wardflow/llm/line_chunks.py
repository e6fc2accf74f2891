"""Removing passages that repeat across documents, by content-defined chunks of lines.

A chunk ends where a rolling hash over the hashes of two neighbouring lines says so, hence at the same
lines wherever a passage is put, except at its edges. Lines of ``LONG_LINE`` words or more are a chunk
each, as they are passages already. Chunks that occur again (several lines, or a long one) are kept
where they come first by document and place, and removed elsewhere, once their bytes were compared.
A document of which every chunk came before, single short lines too, is emptied: it is a copy.

``dedup_passages`` knows no chunks: it removes every run of lines with over ``PASSAGE_WORDS`` words that
came before, whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One boundary in so many lines.
SPREAD = 3
#: Blanks in a line that make it long.
LONG_LINE = 50
#: A run of lines with more words than this is a passage.
PASSAGE_WORDS = 50


def _is_long(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) >= LONG_LINE


def _chunks(text: Column) -> Column:
    """The chunks of a text: ``at`` (number of its first line, from 0), ``lines`` and ``body``."""
    lines = F.split(text, "\n", -1)
    hashed = F.transform(lines, lambda line: F.struct(F.xxhash64(line).alias("h"), _is_long(line).alias("long")))
    # Bound once by transforms over one element: a lambda's argument is not computed again at each use.
    return F.flatten(
        F.transform(
            F.array(F.struct(lines.alias("lines"), hashed.alias("marks"))),
            lambda held: _cut(held["lines"], held["marks"]),
        )
    )


def _cut(lines: Column, marks: Column) -> Column:
    def opens(mark: Column, i: Column) -> Column:
        before = F.get(marks, i - 1)
        # The hash over the two lines in front of this one.
        rolled = F.xxhash64(before["h"], F.coalesce(F.get(marks, i - 2)["h"], F.lit(0).cast("long")))
        return (i == 0) | mark["long"] | before["long"] | (F.pmod(rolled, F.lit(SPREAD)) == 0)

    numbered = F.transform(marks, lambda mark, i: F.when(opens(mark, i), i))
    starts = F.filter(numbered, lambda i: i.isNotNull())

    def chunks(at: Column) -> Column:
        def chunk(start: Column, k: Column) -> Column:
            size = F.coalesce(F.get(at, k + 1), F.size(lines)) - start
            return F.struct(
                start.alias("at"),
                size.alias("lines"),
                F.array_join(F.slice(lines, start + 1, size), "\n").alias("body"),
            )

        return F.transform(at, chunk)

    return F.flatten(F.transform(F.array(starts), chunks))


def _said(chunk: Column) -> Column:
    return chunk["body"].rlike(r"\S")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` less the chunks that came before, and ``n_removed_chunks`` and
    ``n_removed_lines`` (columns of these names are replaced).

    A chunk comes first in the document with the smallest id (null before all), there at its first
    place. Null texts stay null; a text of which all was removed is empty. Rows that repeat both id
    and text are one document. Blank chunks are never removed. Texts of any length are handled in
    their row; a chunk found in very many documents is summed up in the map tasks first.
    """
    own = [c for c in docs.columns if c not in ("n_removed_chunks", "n_removed_lines")]
    named = docs.select(*[F.col(f"`{c}`") for c in own])
    text = F.col(f"`{text_col}`")
    keyed = named.withColumn("_print", F.xxhash64(text)).withColumn("_key", F.col(f"`{id_col}`"))
    chunk = F.col("chunk")
    opened = keyed.filter(text.isNotNull()).select("_key", "_print", F.explode(_chunks(text)).alias("chunk"))
    wide = (chunk["lines"] > 1) | _is_long(chunk["body"])
    passages = opened.filter(_said(chunk)).select(
        "_key",
        "_print",
        wide.alias("wide"),
        chunk["at"].alias("at"),
        F.xxhash64(chunk["body"]).alias("hash"),
        F.octet_length(chunk["body"]).alias("bytes"),
        chunk["lines"].alias("lines"),
        chunk["body"].alias("body"),
    )
    place = F.struct("_key", "_print", "at")
    # The least and the greatest body of a hash agree only if all its bodies are the same bytes.
    repeated = (
        passages.groupBy("hash", "bytes")
        .agg(F.count("*").alias("n"), F.min("body").alias("lo"), F.max("body").alias("hi"), F.min(place).alias("first"))
        .filter((F.col("n") > 1) & (F.col("lo") == F.col("hi")))
        .select("hash", "bytes", "first")
    )
    later = passages.drop("body").join(repeated, ["hash", "bytes"]).filter(place != F.col("first"))
    removed = later.groupBy("_key", "_print").agg(
        F.collect_set(F.struct("at", "lines", "wide")).alias("repeats")
    )
    removed = removed.select(F.col("_key").alias("r_key"), F.col("_print").alias("r_print"), "repeats")
    both = keyed.join(
        removed, F.col("_key").eqNullSafe(F.col("r_key")) & (F.col("_print") == F.col("r_print")), "left"
    )
    chunks = F.when(F.col("repeats").isNotNull(), _chunks(text)).alias("_chunks")
    opened = both.select(*own, "repeats", chunks)
    copy = F.size("repeats") == F.size(F.filter("_chunks", _said))
    gone = F.when(copy, F.col("repeats")).otherwise(F.filter("repeats", lambda r: r["wide"]))
    judged = opened.select(*own, "_chunks", gone.alias("_gone"))
    kept = F.filter("_chunks", lambda c: ~F.array_contains(F.col("_gone.at"), c["at"]))
    less = F.array_join(F.transform(kept, lambda c: c["body"]), "\n")
    columns = {c: F.col(f"`{c}`") for c in own}
    columns[text_col] = F.when(F.col("_gone").isNull(), text).otherwise(less)
    lines = F.aggregate("_gone", F.lit(0).cast("long"), lambda n, r: n + r["lines"])
    return judged.select(
        *[value.alias(name) for name, value in columns.items()],
        F.coalesce(F.size(F.col("_gone")), F.lit(0)).cast("long").alias("n_removed_chunks"),
        F.coalesce(lines, F.lit(0).cast("long")).alias("n_removed_lines"),
    )


def _marks(text: Column) -> Column:
    """The lines with words of a text: ``at`` (number, from 0), ``h``, ``words`` and ``next`` (the number of
    the next such line, or of lines)."""
    lines = F.split(text, "\n", -1)
    counted = F.transform(
        lines,
        lambda line, i: F.struct(
            i.alias("at"), F.xxhash64(line).alias("h"), F.regexp_count(line, F.lit(r"\S+")).alias("words")
        ),
    )
    said = F.filter(counted, lambda mark: mark["words"] > 0)
    # Bound once by transforms over one element: a lambda's argument is not computed again at each use.
    return F.flatten(
        F.transform(
            F.array(F.struct(said.alias("said"), F.size(lines).alias("n"))),
            lambda held: F.transform(
                held["said"],
                lambda mark, i: F.struct(
                    mark["at"].alias("at"),
                    mark["h"].alias("h"),
                    mark["words"].alias("words"),
                    F.coalesce(F.get(held["said"], i + 1)["at"], held["n"]).alias("next"),
                ),
            ),
        )
    )


def _ends(words: Column) -> Column:
    """For each line the last one of the shortest passage from it, or the number of lines if there is none."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))

    def end(_: Column, i: Column) -> Column:
        def step(run: Column, n: Column) -> Column:
            longer = F.struct((run["words"] + n).alias("words"), (run["lines"] + 1).alias("lines"))
            return F.when(run["words"] > PASSAGE_WORDS, run).otherwise(longer)

        def last(run: Column) -> Column:
            return F.when(run["words"] > PASSAGE_WORDS, i + run["lines"] - 1).otherwise(F.size(words))

        # Every line here has a word, so no shortest passage has more lines than this slice.
        return F.aggregate(F.slice(words, i + 1, F.lit(PASSAGE_WORDS + 1)), start, step, last)

    return F.transform(words, end)


def _runs(text: Column) -> Column:
    """The shortest passages of a text: ``at`` and ``stop`` (numbers of its first line and of the line behind
    it and the blank lines after it), ``prints`` (its lines' hashes) and ``whole``.

    For every line there is the shortest passage that begins with it, and the shortest that ends with it.
    They cover any passage from within: a line by the first kind if words enough follow it in the passage,
    else by the one that ends with the passage. A text too short for a passage is one run, ``whole``.
    """

    def of_text(held: Column) -> Column:
        marks, ends = held["marks"], held["ends"]

        def run(first: Column, last: Column, whole: bool) -> Column:
            return F.struct(
                F.get(marks, first)["at"].alias("at"),
                F.get(marks, last)["next"].alias("stop"),
                F.transform(F.slice(marks, first + 1, last - first + 1), lambda mark: mark["h"]).alias("prints"),
                F.lit(whole).alias("whole"),
            )

        def of_line(end: Column, i: Column) -> Column:
            # Lines behind this end, but before the next line's, have their shortest passage from here.
            behind = F.greatest(end, F.coalesce(F.get(ends, i + 1), F.size(marks)) - 1)
            stops = F.when(end < F.size(marks), F.sequence(end, behind)).otherwise(F.array().cast("array<int>"))
            return F.transform(stops, lambda last: run(i, last, False))

        short = F.get(ends, F.lit(0)) == F.size(marks)
        all_lines = F.array(run(F.lit(0), F.size(marks) - 1, True))
        return F.when(short, all_lines).otherwise(F.flatten(F.transform(ends, of_line)))

    marked = F.transform(
        F.array(_marks(text)),
        lambda marks: F.struct(marks.alias("marks"), _ends(F.transform(marks, lambda mark: mark["words"])).alias("ends")),
    )
    return F.flatten(F.transform(marked, of_text))


def _clashing(docs: DataFrame, text: Column) -> list[int]:
    """Hashes that different lines share, by their bytes: none is expected below a billion lines."""
    lines = docs.select(F.explode(F.split(text, "\n", -1)).alias("line")).filter(F.col("line").rlike(r"\S"))
    ends = lines.groupBy(F.xxhash64("line").alias("h")).agg(F.min("line").alias("lo"), F.max("line").alias("hi"))
    return [r["h"] for r in ends.filter(F.col("lo") != F.col("hi")).select("h").collect()]


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` less every line of a passage that came before, and ``n_removed_lines``
    (a column of this name is replaced).

    A passage is a run of lines with over ``PASSAGE_WORDS`` words (runs of non-blanks). It comes first in the
    document with the smallest id (null before all), there at its first place. Blank lines do not tell
    passages apart, and go with the line they follow. A text that has no passage goes if an earlier one has
    the same lines. Null texts stay null; a text of which no word is left is empty. Rows that repeat both
    id and text are one document. Lines whose hash another line shares are never removed.
    """
    own = [c for c in docs.columns if c != "n_removed_lines"]
    named = docs.select(*[F.col(f"`{c}`") for c in own])
    text = F.col(f"`{text_col}`")
    keyed = named.withColumn("_print", F.xxhash64(text)).withColumn("_key", F.col(f"`{id_col}`"))
    clashing = _clashing(named, text)
    opened = keyed.filter(text.isNotNull()).select("_key", "_print", F.inline(_runs(text)))
    if clashing:
        opened = opened.filter(~F.arrays_overlap("prints", F.array(*[F.lit(h) for h in clashing])))
    place = F.struct("_key", "_print", "at")
    repeated = (
        opened.groupBy("prints", "whole")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .filter(F.col("n") > 1)
        .select("prints", "whole", "first")
    )
    later = opened.join(repeated, ["prints", "whole"]).filter(place != F.col("first"))
    removed = later.groupBy("_key", "_print").agg(F.collect_set(F.struct("at", "stop")).alias("_runs"))
    removed = removed.select(F.col("_key").alias("r_key"), F.col("_print").alias("r_print"), "_runs")
    both = keyed.join(
        removed, F.col("_key").eqNullSafe(F.col("r_key")) & (F.col("_print") == F.col("r_print")), "left"
    )
    lines = F.split(text, "\n", -1)
    gone = F.flatten(F.transform("_runs", lambda run: F.sequence(run["at"], run["stop"] - 1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    judged = both.select(*own, "_runs", F.when(F.col("_runs").isNotNull(), lines).alias("_lines"), kept.alias("_kept"))
    judged = judged.withColumn(
        "_left", F.transform(F.array("_lines"), lambda held: F.transform("_kept", lambda i: F.get(held, i)))[0]
    )
    less = F.array_join("_left", "\n")
    columns = {c: F.col(f"`{c}`") for c in own}
    columns[text_col] = F.when(F.col("_runs").isNull(), text).when(less.rlike(r"\S"), less).otherwise("")
    return judged.select(
        *[value.alias(name) for name, value in columns.items()],
        F.coalesce(F.size("_lines") - F.size("_kept"), F.lit(0)).cast("long").alias("n_removed_lines"),
    )
