"""Benchmark passages in training texts, by a positional inverted index.

1. Corpus frequencies of all benchmark words; of every window of an item the two rarest words are its
   anchors (one, if it has one word).
2. The index: for anchor words only, in which document and at which place they stand. Together with the
   place of the anchor in its item a posting names an alignment: document, item, and where the item
   would begin. Windows that occur have all their anchors on one alignment, so the offset-adjusted
   lists of anchors are intersected by counting anchors per alignment.
3. What is left is compared word by word with the text, which gives the windows that really occur.

Alignments with anchors that only nearly agree are proximity matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardflow.llm.licenses import GAPS
from wardflow.session import materialize

WINDOW = 10
ANCHORS = 2
#: Anchors of one item whose alignments differ by so many words at most are near each other.
SLACK = 4
#: Rows of benchmark words or anchors up to which they are sent to every executor (some 100 bytes each).
SENT_ROWS = 300_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, GAPS), lambda w: w != "")


def exact_words(text: Column) -> Column:
    """Words with A-Z as small letters and all else as it is."""
    return _words(F.translate(text, _UPPER, _LOWER))


def search_words(text: Column) -> Column:
    """The same words with more letters made small: faster, equal for equal words, and as many."""
    return _words(F.lower(text))


def read_items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id``, ``words`` and ``win`` (the length of its windows) of every item with words."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("item_id"), exact_words(F.col(f"`{text_col}`")).alias("words"))
    items = items.filter(F.size("words") > 0).distinct()
    return items.withColumn("win", F.least(F.size("words"), F.lit(WINDOW)))


def _sent(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it is small enough; else the join shuffles by word."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def frequencies(docs: DataFrame, items: DataFrame, text_col: str) -> DataFrame:
    """``word, n``: how often each benchmark word stands in the whole corpus (0 if never)."""
    vocabulary = items.select(F.explode("words").alias("word")).select(F.lower("word").alias("word")).distinct()
    vocabulary = materialize(vocabulary, "benchmark-words")
    said = docs.select(F.explode(search_words(F.col(f"`{text_col}`"))).alias("said"))
    counts = said.join(_sent(vocabulary), F.col("said") == F.col("word")).groupBy("word").agg(F.count("*").alias("n"))
    return vocabulary.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def anchors(items: DataFrame, counts: DataFrame) -> DataFrame:
    """``item_id, offset, word``: the rarest places of every window of every item."""
    placed = items.select("item_id", "words", "win", F.posexplode("words").alias("offset", "exact"))
    placed = placed.withColumn("word", F.lower("exact")).join(counts, "word")
    ranked = placed.groupBy("item_id", "words", "win").agg(
        F.sort_array(F.collect_list(F.struct("offset", "n", "word"))).alias("places")
    )
    starts = F.sequence(F.lit(0), F.size("words") - F.col("win"))
    windows = ranked.select("item_id", "win", "places", F.explode(starts).alias("start"))
    inside = F.slice("places", F.col("start") + 1, F.col("win"))
    rarest = F.slice(
        F.array_sort(F.transform(inside, lambda p: F.struct(p["n"], p["offset"], p["word"]))), 1, ANCHORS
    )
    chosen = windows.select("item_id", F.explode(rarest).alias("a"))
    return chosen.select("item_id", F.col("a.offset").alias("offset"), F.col("a.word").alias("word")).distinct()


def postings(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The index for the anchors' words: ``word, doc_id, print, place``; ``print`` is the text's hash."""
    text = F.col(f"`{text_col}`")
    said = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.xxhash64(text).alias("print"),
        F.posexplode(search_words(text)).alias("place", "said"),
    )
    wanted = materialize(chosen.select("word").distinct(), "anchor-words")
    found = said.join(_sent(wanted), F.col("said") == F.col("word"))
    return found.select("word", "doc_id", "print", "place")


def alignments(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """``item_id, doc_id, print, begin, offset``: every anchor posting as an alignment of its item."""
    paired = index.join(_sent(chosen), "word")
    begin = (F.col("place") - F.col("offset")).alias("begin")
    return paired.select("item_id", "doc_id", "print", begin, "offset")


def _agreeing(aligned: DataFrame, items: DataFrame) -> DataFrame:
    """Alignments with as many different anchors as any window has, with their item's words."""
    groups = aligned.groupBy("item_id", "doc_id", "print", "begin").agg(F.size(F.collect_set("offset")).alias("held"))
    known = items.select("item_id", "words", "win")
    paired = groups.join(known, groups["item_id"].eqNullSafe(known["item_id"])).select(groups["*"], "words", "win")
    return paired.filter(F.col("held") >= F.least(F.lit(ANCHORS), F.col("win")))


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (sorted ids of items with windows that occur),
    ``hit_places`` (places of hit words) and ``near_items`` (sorted ids of proximity matches, whether their
    windows occur or not); columns of these names are replaced.

    Windows are ``WINDOW`` words, of shorter items all their words. Null and empty texts have no words
    and hit nothing; items without words or, of equal rows, all but one are left out; an item id may be
    null. Rows that repeat id and text each get the same result. Whole texts are read three times:
    for frequencies, for postings and for the comparison.
    """
    new = ("n_words", "n_hit", "items", "hit_places", "near_items")
    own = [c for c in docs.columns if c not in new]
    rows = docs.select(*[F.col(f"`{c}`") for c in own])
    items = materialize(read_items(benchmark, item_col, item_text_col), "benchmark-items")
    chosen = materialize(anchors(items, frequencies(rows, items, text_col)), "benchmark-anchors")
    index = materialize(postings(rows, chosen, id_col, text_col), "postings")
    aligned = alignments(index, chosen)
    exact = F.struct("item_id", "begin", "words", "win").alias("exact")
    found = _agreeing(aligned, items).select("doc_id", "print", exact)
    # Named as in ``items``; an item without an id has no name.
    near = proximity_matches(aligned).select("doc_id", "print", F.col("item_id").cast("string").alias("near"))
    both_kinds = found.unionByName(near, allowMissingColumns=True)
    per_text = both_kinds.groupBy("doc_id", "print").agg(
        F.collect_list("exact").alias("found"), F.collect_set("near").alias("_near")
    )
    per_text = per_text.select(F.col("doc_id").alias("f_id"), F.col("print").alias("f_print"), "found", "_near")
    text = F.col(f"`{text_col}`")
    keyed = rows.withColumn("_print", F.xxhash64(text))
    both = keyed.join(
        per_text,
        F.col(f"`{id_col}`").eqNullSafe(F.col("f_id")) & (F.col("_print") == F.col("f_print")),
        "left",
    )
    open_words = F.when(F.size("found") > 0, exact_words(text)).otherwise(search_words(text))
    worded = both.select(*own, "found", "_near", open_words.alias("_words"))
    checked = F.transform("found", lambda f: _occurrences(f, F.col("_words")))
    judged = worded.select(*own, "_near", "_words", F.filter(checked, lambda c: F.size(c["places"]) > 0).alias("_hits"))
    places = F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda c: c["places"]))))
    names = F.array_sort(F.array_distinct(F.transform("_hits", lambda c: c["item_id"].cast("string"))))
    none = F.array()
    return judged.select(
        *own,
        F.coalesce(F.size(F.col("_words")), F.lit(0)).alias("_n"),
        F.coalesce(places, none.cast("array<int>")).alias("hit_places"),
        F.coalesce(names, none.cast("array<string>")).alias("items"),
        F.coalesce(F.array_sort("_near"), none.cast("array<string>")).alias("near_items"),
    ).select(
        *own,
        F.greatest(F.col("_n"), F.lit(0)).cast("long").alias("n_words"),
        F.size("hit_places").cast("long").alias("n_hit"),
        "items",
        "hit_places",
        "near_items",
    )


def _occurrences(found: Column, words: Column) -> Column:
    """The item and the places of words in its windows that occur at this alignment."""
    item, begin, win = found["words"], found["begin"], found["win"]
    same = F.transform(item, lambda w, k: w.eqNullSafe(F.get(words, begin + k)))

    def starts(equal: Column) -> Column:
        possible = F.sequence(F.lit(0), F.size(equal) - win)
        return F.filter(possible, lambda s: ~F.array_contains(F.slice(equal, s + 1, win), False))

    # Held in a one-element array so that the comparison is made once.
    begun = F.flatten(F.transform(F.array(same), starts))
    covered = F.flatten(F.transform(begun, lambda s: F.sequence(begin + s, begin + s + win - 1)))
    return F.struct(found["item_id"].alias("item_id"), covered.alias("places"))


def proximity_matches(aligned: DataFrame) -> DataFrame:
    """``item_id, doc_id, print`` where two different anchors of an item stand in a text within ``SLACK``
    words of the distance they have in the item, but not at it.

    Every alignment is held against all that begin up to ``SLACK`` words later: another anchor is among
    them if their least or their greatest is another.
    """
    ahead = W.partitionBy("item_id", "doc_id", "print").orderBy("begin").rangeBetween(1, SLACK)
    other = (F.min("offset").over(ahead) != F.col("offset")) | (F.max("offset").over(ahead) != F.col("offset"))
    near = aligned.withColumn("near", other)
    return near.filter("near").select("item_id", "doc_id", "print").distinct()


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items with windows that occur, whether there are any, and items near."""
    found = find(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near"),
    )


#: The same from DuckDB: all windows of all texts, and all pairs of anchors' alignments.
SQL = r"""
with texts as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from documents
), items as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from benchmark
), sized as (
    select item_id, words, least(len(words), 10) as win from items where len(words) > 0
), item_windows as (
    select distinct item_id, win, array_to_string(words[s + 1:s + win], ' ') as gram
    from (select *, unnest(range(len(words) - win + 1)) as s from sized)
), doc_windows as (
    select doc_id, win, s, array_to_string(words[s + 1:s + win], ' ') as gram from (
        select doc_id, words, win, unnest(range(len(words) - win + 1)) as s
        from texts, (select distinct win from sized) where len(words) >= win
    )
), hits as (
    select doc_id, s, win, item_id from doc_windows join item_windows using (win, gram)
), places as (
    select doc_id, count(distinct place) as n_hit
    from (select doc_id, unnest(range(s, s + win)) as place from hits) group by doc_id
), named as (
    select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as names
    from (select distinct doc_id, item_id from hits) group by doc_id
), item_words as (
    select distinct item_id, words, win, unnest(range(len(words))) as place, unnest(list_transform(words, lambda w: lower(w))) as word
    from sized where item_id is not null
), doc_words as (
    select doc_id, unnest(range(len(words))) as place, unnest(list_transform(words, lambda w: lower(w))) as word from texts
), said as (
    select word, count(*) as n from doc_words semi join item_words using (word) group by word
), anchors as (
    select distinct item_id, place, word from (
        select item_id, words, i.win, s, place, word, coalesce(n, 0) as n
        from (select *, unnest(range(len(words) - win + 1)) as s from sized where item_id is not null) w
            join item_words i using (item_id, words) left join said using (word)
        where place between s and s + w.win - 1
        qualify row_number() over (partition by item_id, words, s order by coalesce(n, 0), place, word) <= 2)
), aligned as (
    select distinct item_id, doc_id, d.place - a.place as begin, a.place as anchor from doc_words d join anchors a using (word)
), near as (
    select a.doc_id, count(distinct a.item_id) as n_near
    from aligned a join aligned b on a.item_id = b.item_id and a.doc_id is not distinct from b.doc_id
        and b.begin - a.begin between 1 and 4 and a.anchor <> b.anchor
    group by a.doc_id
)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, coalesce(n_near, 0) as n_near
from texts left join places using (doc_id) left join named using (doc_id) left join near using (doc_id)
"""
