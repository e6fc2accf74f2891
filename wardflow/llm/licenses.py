"""License lines by an exact set-similarity join against templates.

A template is the set of words of a license notice; a text block (a line) meets it when it holds at
least ``PERCENT`` of them. Words are ordered by their frequency in the corpus, rarest first. A block
that meets a template of n words must hold one of its n - least + 1 rarest words (prefix filter), must
have enough template words at all (length filter), and enough of them from the shared word on
(positional filter); what is left is counted exactly. Fixed phrases are reported wherever they stand.

Notices are often wrapped, so windows over a document's words, across its lines, are blocks too. Only
documents that hold enough words of a template at all are searched for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.session import materialize

#: Phrases that are always reported, with their labels (fixed values).
PHRASES = {
    "cc-by": ("cc", "by"),
    "gpl": ("general", "public", "license"),
    "reserved": ("all", "rights", "reserved"),
}
PERCENT = 80
#: Notices by label; a label may have several. The words are public notices'.
TEMPLATES: Sequence[tuple[str, str]] = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
)
#: Everything that is not part of a word once A-Z are small letters.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def small_letters(text: Column) -> Column:
    """A-Z as a-z. Other letters may change case too, but none turns into one of a-z."""
    return F.when(text.rlike("[İK]"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.filter(F.split(small_letters(text), GAPS), lambda w: w != "")


def _places(words: Column, phrase: Sequence[str]) -> Column:
    def stands(word: Column, i: Column) -> Column:
        same = word == phrase[0]
        for k, wanted in enumerate(phrase[1:], 1):
            same = same & (F.get(words, i + k) == wanted)
        return F.when(same, i)

    return F.filter(F.transform(words, stands), lambda i: i.isNotNull())


def _wrapped(words: Column, held: Column, templates: Sequence[tuple[str, str]], percent: int) -> Column:
    """``label`` and ``share`` of the templates that windows of ``words`` meet; ``held``: the distinct template words.

    A window is longer than its notice by as much as the notice may lack.
    """

    def met(label: str, notice: str) -> Column:
        wanted = sorted(set(notice.split()))
        least, width = ceil(percent * len(wanted) / 100), ceil(100 * len(notice.split()) / percent)
        known = F.array(*[F.lit(w) for w in wanted])
        spots = F.filter(
            F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
            lambda spot: F.array_contains(known, spot["word"]),
        )

        def best(spots: Column) -> Column:
            def common(spot: Column, k: Column) -> Column:
                # The window from here holds enough template words, before it is looked at which.
                enough = F.get(spots, k + least - 1)["at"] - spot["at"] < width
                near = F.filter(F.slice(spots, k + 1, width), lambda s: s["at"] - spot["at"] < width)
                return F.when(enough, F.size(F.array_distinct(F.transform(near, lambda s: s["word"])))).otherwise(0)

            return F.array_max(F.transform(spots, common))

        # Held in a one-element array so that the places are found once.
        most = F.transform(F.array(spots), best)
        share = F.filter(most, lambda n: n >= least)
        found = F.transform(share, lambda n: F.struct(F.lit(label).alias("label"), (n / len(wanted)).alias("share")))
        none = F.array().cast("array<struct<label:string,share:double>>")
        return F.when(F.size(F.array_intersect(held, known)) >= least, found).otherwise(none)

    # A notice without words meets nothing.
    each = [met(label, notice) for label, notice in templates if notice.split()]
    return F.concat(*each) if each else F.array().cast("array<struct<label:string,share:double>>")


def read_blocks(
    docs: DataFrame, templates: Sequence[tuple[str, str]], id_col: str, text_col: str, percent: int = PERCENT
) -> DataFrame:
    """Per document its number of words, the places of phrases, per line the template words in it, and the
    templates that windows across lines meet."""
    vocabulary = sorted({w for _, notice in templates for w in notice.split()})
    known = F.array(*[F.lit(w) for w in vocabulary])
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    anywhere = "|".join("[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+".join(p) for p in PHRASES.values())
    lined = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        text.rlike(f"(?i)(?:{anywhere})").alias("has_phrase"),
        F.transform(F.split(text, "\n", -1), words_of).alias("lines"),
    )
    none = F.array().cast("array<int>")
    counted = lined.select(
        "doc_id",
        F.aggregate("lines", F.lit(0).cast("long"), lambda n, words: n + F.size(words)).alias("n_words"),
        F.when(F.col("has_phrase"), F.flatten("lines")).alias("words"),
        "lines",
        F.filter(
            F.transform("lines", lambda words: F.array_intersect(words, known)), lambda hits: F.size(hits) > 0
        ).alias("blocks"),
    )
    places = [F.coalesce(_places(F.col("words"), p), none).alias(label) for label, p in PHRASES.items()]
    held = F.array_distinct(F.flatten("blocks"))
    # Windows within one line hold no more than the line.
    wrapped = F.when(F.size("blocks") > 1, _wrapped(F.flatten("lines"), held, templates, percent))
    return counted.select("doc_id", "n_words", F.struct(*places).alias("places"), "blocks", wrapped.alias("wrapped"))


def word_order(blocks: DataFrame) -> list[str]:
    """The template words that occur, rarest first, by the number of lines they are in.

    At most as many rows as the templates have words come to the driver.
    """
    held = blocks.select(F.explode("blocks").alias("hits")).select(F.explode("hits").alias("word"))
    counts = held.groupBy("word").agg(F.count("*").alias("n")).orderBy("n", "word")
    return [r["word"] for r in counts.collect()]


def matches(blocks: DataFrame, templates: Sequence[tuple[str, str]], percent: int) -> DataFrame:
    """``row``, ``label`` and ``share`` (of the template's words) of every line that meets a template."""
    rank = {word: k for k, word in enumerate(word_order(blocks))}
    spark = blocks.sparkSession
    index, notices = [], []
    for number, (label, notice) in enumerate(templates):
        words = set(notice.split())
        least = ceil(percent * len(words) / 100)
        present = sorted((w for w in words if w in rank), key=rank.__getitem__)
        missing = len(words) - len(present)  # they are the rarest of all and match nothing
        notices.append((number, label, present, least, len(words)))
        index += [
            (word, number, missing + place, len(words), least)
            for place, word in enumerate(present)
            if missing + place < len(words) - least + 1
        ]
    index = spark.createDataFrame(index, "word string, template int, place int, size int, least int")
    notices = spark.createDataFrame(notices, "template int, label string, words array<string>, least int, size int")
    order = F.create_map(*[F.lit(x) for pair in rank.items() for x in pair]) if rank else None
    if order is None:
        return blocks.select("row", F.lit("").alias("label"), F.lit(0.0).alias("share")).limit(0)
    prefix = sorted({r["word"] for r in index.collect()}, key=rank.__getitem__)  # of our own rows above
    line = F.col("hits")
    opened = blocks.select("row", F.explode("blocks").alias("hits"))
    near = opened.filter(F.arrays_overlap(line, F.array(*[F.lit(w) for w in prefix]))) if prefix else opened.limit(0)
    ranked = near.select(
        "row", F.array_sort(F.transform(line, lambda w: F.struct(order[w].alias("rank"), w.alias("word")))).alias("hits")
    )
    shared = ranked.select("row", "hits", F.size("hits").alias("held"), F.posexplode("hits").alias("at", "hit"))
    # The index and the notices are as large as the template list in the plan, whatever the corpus.
    paired = shared.join(F.broadcast(index), F.col("hit.word") == F.col("word"))
    enough = F.least(F.col("size") - F.col("place"), F.col("held") - F.col("at")) >= F.col("least")
    candidates = paired.filter((F.col("held") >= F.col("least")) & enough).select("row", "hits", "template").distinct()
    checked = candidates.join(F.broadcast(notices), "template")
    common = F.size(F.array_intersect(F.col("hits.word"), F.col("words")))
    return checked.filter(common >= F.col("least")).select("row", "label", (common / F.col("size")).alias("share"))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: words, places of phrases, labels and a score.

    The score is 1 with a phrase, else the greatest share of a template met, else 0. Null and empty
    texts have no words. Texts are read once, whole; their template words are written and used from
    there. Repeated rows, and rows with one id or none, each get their own result.
    """
    rows = read_blocks(docs, templates, id_col, text_col, percent).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "license-blocks")
    met = matches(rows.select("row", "blocks"), templates, percent)
    met = met.groupBy("row").agg(F.collect_set("label").alias("met"), F.max("share").alias("share"))
    both = rows.join(met, "row", "left")
    all_places = F.concat(*[F.col(f"places.`{label}`") for label in PHRASES])
    labels = F.filter(
        F.array(*[F.when(F.size(F.col(f"places.`{label}`")) > 0, F.lit(label)) for label in PHRASES]),
        lambda label: label.isNotNull(),
    )
    none = F.array().cast("array<string>")
    across = F.coalesce(F.col("wrapped.label"), none)
    every = F.array_distinct(F.concat(labels, F.coalesce("met", none), across))
    share = F.greatest("share", F.array_max("wrapped.share"), F.lit(0.0))
    return both.select(
        "doc_id",
        "n_words",
        F.size(all_places).cast("long").alias("n_base"),
        F.array_min(all_places).cast("long").alias("first_word"),
        F.array_max(all_places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size(labels) > 0, 1.0).otherwise(share).alias("score"),
    )


def check_sql(templates: Sequence[tuple[str, str]] = TEMPLATES, percent: int = PERCENT, phrases: Mapping = PHRASES) -> str:
    """The same from DuckDB, every line against every template; it knows no windows across lines."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    rows = ", ".join(f"('{label}', {sorted(set(notice.split()))})" for label, notice in templates)
    parts = []
    for label, phrase in phrases.items():
        test = " and ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase, 1))
        parts.append(f"list_filter(range(len(words)), lambda i: {test}) as \"{label}\"")
    lists = ", ".join(f'"{label}"' for label in phrases)
    flags = " , ".join(f"case when len(\"{label}\") > 0 then '{label}' end" for label in phrases)
    return f"""
with templates(label, notice) as (values {rows}),
texts as (select row_number() over () as r, doc_id, lower(coalesce(text, '')) as body from documents),
blocks as (
    select r, list_distinct(regexp_extract_all(unnest(string_split(body, chr(10))), '{word}')) as held from texts
),
met as (
    select r, list(distinct label) as met, max(share) as share from (
        select r, label, len(list_intersect(held, notice)) / len(notice) as share,
            100 * len(list_intersect(held, notice)) >= {percent} * len(notice) as enough
        from blocks, templates
    ) where enough group by r
),
worded as (select r, doc_id, regexp_extract_all(body, '{word}') as words from texts),
placed as (select r, doc_id, len(words) as n_words, {", ".join(parts)} from worded),
joined as (
    select *, flatten([{lists}]) as places,
        list_filter([{flags}], lambda x: x is not null) as base
    from placed left join met using (r)
)
select doc_id, n_words, len(places) as n_base, list_min(places) as first_word, list_max(places) as last_word,
    array_to_string(list_sort(base), ',') as base_labels,
    array_to_string(list_sort(list_distinct(list_concat(base, coalesce(met, [])))), ',') as labels,
    case when len(base) > 0 then 1.0::double else coalesce(share, 0.0)::double end as score
from joined
"""
