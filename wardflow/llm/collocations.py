"""Phrase mining: counts of all phrases of 2 to 4 words, per language, from FM-indexes of shards.

Every task packs its texts into shards of one language and indexes each. No text is read again: phrases
grow in the indexes, level by level. A phrase reaches the least count only if its parts do, with a word
beside them; so after each level the shards are told which of their phrases have that count of words to
their left and to their right over all shards, and extend only these. Phrases of four words leave a task
summed over a group of shards of one language.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm import fm_index
from wardflow.llm.arrays import Texts, mixed, slices
from wardflow.llm.common import bounded_batches, release_memory
from wardflow.session import materialize

#: Words of one shard, and of all shards that a task has open; a longer text is not cut.
SHARD_WORDS, OPEN_WORDS = 2_000_000, 3_000_000

#: Words of the shards whose phrases of four words are summed in one task; a single shard may have more.
GROUP_WORDS = 16_000_000

#: Rows that leave a task at once.
OUT_ROWS = 100_000

#: Least count of a phrase.
LEAST = 30

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_OUTSIDE = _PIECE_END.copy()
_OUTSIDE[[0x20, 0x09]] = True

_STEP = np.uint64(0xD1342543DE82EF95)


def words_of(texts: pa.Array) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in lower case; each word's start and end, and whether it begins a piece."""
    read = Texts(texts, lower=True)
    owner, start, end = read.runs(~_OUTSIDE[read.data])
    ends = np.concatenate([[0], np.cumsum(_PIECE_END[read.data])])
    first = np.ones(len(start), bool)
    first[1:] = (np.diff(owner) != 0) | (ends[start[1:]] != ends[end[:-1]])
    return read, start, end, first


def language_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


class _Shard:
    """The words of one language that a task has read since its last shard."""

    def __init__(self, lang: str):
        self.lang, self.salt = lang, language_key(lang)
        self.keys: list[np.ndarray] = []
        self.firsts: list[np.ndarray] = []
        self.known = np.zeros(0, np.uint64)
        self.names: list[np.ndarray] = []
        self.n = 0

    def add(self, texts: pa.Array) -> None:
        read, start, end, first = words_of(texts)
        keys = mixed(read.fingerprints(start, end) ^ self.salt)
        if not len(keys):
            return
        found, at = np.unique(keys, return_index=True)
        new = np.isin(found, self.known, assume_unique=True, invert=True)
        names = np.array([read.string(start[k], end[k]) for k in at[new]], object)
        self.known = np.concatenate([self.known, found[new]])
        self.names.append(names)
        self.keys.append(keys)
        self.firsts.append(first)
        self.n += len(keys)

    def row(self, number: int) -> pa.RecordBatch:
        keys, first = np.concatenate(self.keys), np.concatenate(self.firsts)
        found, word, counts = np.unique(keys, return_inverse=True, return_counts=True)
        # Numbers by falling count, so that frequent words have small ones.
        rank = np.empty(len(found), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(1, len(found) + 1)
        place = np.arange(1, len(word) + 1) + np.cumsum(first) - 1
        sequence = np.zeros(int(place[-1]) + 2, np.int32)
        sequence[place] = rank[word]
        by_rank = np.argsort(rank)
        names = np.concatenate(self.names)[np.argsort(self.known)][by_rank]
        values = [
            number, self.lang, len(sequence), fm_index.packed(fm_index.bwt(sequence)), fm_index.packed(fm_index.bwt(sequence[::-1])),
            found[by_rank].view(np.int64), names.tolist(), counts[by_rank].tolist(),
        ]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _SHARD_TYPES.types, strict=True)], schema=_SHARD_TYPES)


_SHARD_TYPES = pa.schema(
    [
        ("shard", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("front", pa.binary()), ("back", pa.binary()),
        ("keys", pa.list_(pa.int64())), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
    ]
)
SHARDS = "shard long, lang string, n long, front binary, back binary, keys array<long>, words array<string>, counts array<long>"


def index(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per shard: its two BWTs, its words' keys, the words and their counts.

    Words are told apart by 64-bit keys that depend on the language.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Shard] = {}
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in dict.fromkeys(langs):
                for _, texts in slices(batch.filter(pa.array(langs == lang)), "text"):
                    shard = held.setdefault(lang, _Shard(lang))
                    shard.add(texts)
                    while shard.n >= SHARD_WORDS or sum(s.n for s in held.values()) >= OPEN_WORDS:
                        full = max(held.values(), key=lambda s: s.n)
                        del held[full.lang]
                        yield full.row(number)
                        number += 1
                        shard = held.get(lang, _Shard(lang))
        while held:
            _, left = held.popitem()
            if left.n:
                yield left.row(number)
                number += 1
        release_memory()

    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    return rows.mapInArrow(run, SHARDS)


def phrase_hash(columns: list[np.ndarray]) -> np.ndarray:
    """64 bits for phrases given by the keys of their words, one column per word."""
    found = np.zeros(len(columns[0]), np.uint64)
    for keys in columns:
        found = mixed(found * _STEP + keys)
    return found


def _told_hashes(told: pa.Table) -> dict[tuple[int, str], np.ndarray]:
    """By length and side, the sorted hashes of the phrases told to have the least count of words there."""
    found = {}
    for width in (2, 3):
        for side in ("left", "right"):
            rows = told.filter(pc.and_(pc.equal(told.column("width"), width), told.column(side)))
            found[width, side] = np.sort(phrase_hash([rows.column(k).to_numpy().view(np.uint64) for k in _keys(width)]))
    return found


class _Index:
    """One shard in a task, with the hashes of the phrases that are frequent over all shards."""

    def __init__(self, row: dict, told: dict[tuple[int, str], np.ndarray] | None = None):
        self.shard, self.keys = row["shard"], np.array(row["keys"], np.int64).view(np.uint64)
        self.front = fm_index.Side(fm_index.unpacked(row["front"], row["n"]))
        self.back = fm_index.Side(fm_index.unpacked(row["back"], row["n"]))
        self.told = told

    def columns(self, phrases: fm_index.Phrases) -> list[np.ndarray]:
        return [self.keys[phrases.words[:, k] - 1] for k in range(phrases.words.shape[1])]

    def chosen(self, phrases: fm_index.Phrases, side: str) -> fm_index.Phrases:
        """Those told to have the least count of words on one side. They are met by their hashes; one phrase
        too many does no harm, as whatever grows from it is counted by its keys."""
        frequent = self.told[phrases.words.shape[1], side]
        if not len(frequent):
            return phrases.only(np.zeros(len(phrases), bool))
        hashes = phrase_hash(self.columns(phrases))
        at = np.searchsorted(frequent, hashes)
        at[at == len(frequent)] = 0
        return phrases.only(frequent[at] == hashes)

    def pairs(self) -> fm_index.Phrases:
        return fm_index.extend_left(self.front, fm_index.single(self.front.front))

    def triples(self) -> fm_index.Phrases:
        """Pairs that grow to the left, with each word before them whose pair with the first grows to the right."""
        pairs = self.pairs()
        found = fm_index.extend_left(self.front, self.chosen(pairs, "left"))
        before = self.chosen(pairs, "right")
        return found.only(fm_index.within(found.low, before.low, before.size))

    def fours(self) -> fm_index.Phrases:
        """Triples that grow to the right, with each word after them if the last three words grow to the left."""
        triples = self.triples()
        found = fm_index.extend_right(self.back, self.chosen(triples, "right"))
        after = self.chosen(triples, "left")
        return found.only(fm_index.within(found.low_back, after.low_back, after.size))

    def counted(self, phrases: fm_index.Phrases) -> pa.Table:
        """A row per phrase: the shard, its words' keys, its count, and how often a word stands beside it."""
        width = phrases.words.shape[1]
        columns = [pa.array(k.view(np.int64)) for k in self.columns(phrases)]
        before = phrases.size - self.front.ends(phrases.low, phrases.size)
        after = phrases.size - self.back.ends(phrases.low_back, phrases.size)
        return pa.table([np.full(len(phrases), self.shard), *columns, phrases.size, before, after], schema=_counted_schema(width))


_SUMS = ("a", "n_left", "n_right")


def _counted_schema(width: int) -> pa.Schema:
    return pa.schema([(c, pa.int64()) for c in ("shard", *_keys(width), *_SUMS)])


def _keys(width: int) -> list[str]:
    return [f"k{k}" for k in range(1, width + 1)]


def _counted_ddl(width: int) -> str:
    return ", ".join(f"{c} long" for c in _counted_schema(width).names)


def _rows(table: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    for n in range(table.num_rows):
        yield {name: table.column(name)[n].as_py() for name in table.schema.names}


def _pairs_of_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            held = _Index(row)
            yield from held.counted(held.pairs()).to_batches(max_chunksize=OUT_ROWS)
            del held
    release_memory()


def _triples_of_shard(shard: pa.Table, told: pa.Table) -> pa.Table:
    frequent = _told_hashes(told)
    found = [held.counted(held.triples()) for held in (_Index(row, frequent) for row in _rows(shard))]
    return pa.concat_tables([_counted_schema(3).empty_table(), *found])


def _fours_of_group(shards: pa.Table, told: pa.Table) -> pa.Table:
    """One row per phrase of the group, whose shards are opened one at a time."""
    frequent = _told_hashes(told)
    found = _counted_schema(4).empty_table().drop_columns("shard")
    for row in _rows(shards):
        held = _Index(row, frequent)
        found = _summed(pa.concat_tables([found, held.counted(held.fours()).drop_columns("shard")]), 4)
    release_memory()
    return found


def _summed(counted: pa.Table, width: int) -> pa.Table:
    sums = counted.group_by(_keys(width), use_threads=False).aggregate([(c, "sum") for c in _SUMS])
    return sums.select([*_keys(width), *(f"{c}_sum" for c in _SUMS)]).rename_columns(counted.column_names)


def shard_numbers(shards: DataFrame) -> DataFrame:
    """New numbers of shards, from which ``group_of`` tells their group: shards of one language, of which only
    the last begins within ``GROUP_WORDS`` and may end beyond. One small row per shard is numbered."""
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("shard")) - F.col("n")
    rows = shards.select("shard", "lang", F.floor(before / GROUP_WORDS).alias("part"))
    group = F.dense_rank().over(Window.orderBy("lang", "part")).cast("long")
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy("shard"))
    return rows.select("shard", (F.shiftleft(group, 32) + place).alias("number"))


def group_of(number: Column) -> Column:
    return F.shiftright(number, 32)


def _frequent(counted: DataFrame, width: int, least: int, label: str) -> DataFrame:
    """The phrases of each shard that have the least count over all shards, with their sums over these.

    A phrase has one row per shard that holds it, however often it is there, so no phrase weighs more
    than the number of shards.
    """
    # Sorting by the keys as they are would meet many rows of one first word; mixed with the other keys,
    # which can be undone, the first column tells nearly all phrases apart.
    first, *others = _keys(width)
    mixed_key = reduce(Column.bitwiseXOR, [F.col(k) for k in others], F.col(first)).alias(first)
    same = Window.partitionBy(*_keys(width))
    sums = [F.sum(c).over(same).alias(c) for c in _SUMS]
    found = counted.select("shard", mixed_key, *others, *_SUMS).select("shard", *_keys(width), *sums)
    return materialize(found.filter(F.col("a") >= least).select("shard", mixed_key, *others, *_SUMS), label)


def _growing(phrases: DataFrame, width: int, least: int) -> DataFrame:
    """What shards are told: the phrases that words stand beside often enough for a longer frequent one."""
    left, right = (F.col(c) >= least for c in ("n_left", "n_right"))
    keys = [F.col(k) if k in phrases.columns else F.lit(None).cast("long").alias(k) for k in _keys(3)]
    return phrases.filter(left | right).select("shard", F.lit(width).alias("width"), *keys, left.alias("left"), right.alias("right"))


def _one_row_each(phrases: DataFrame, width: int) -> DataFrame:
    """Phrases once, by an array of their words' keys."""
    rows = phrases.groupBy(*_keys(width)).agg(*[F.max(c).alias(c) for c in _SUMS])
    return rows.select(F.array(*_keys(width)).alias("keys"), *_SUMS)


def count_phrases(shards: DataFrame, least: int = LEAST) -> DataFrame:
    """All phrases of 2 to 4 words that occur ``least`` times: keys of their words, count, and how often a
    word stands before and after them in the same piece."""
    numbers = materialize(shard_numbers(shards), "phrase-shard-numbers")
    shards = shards.join(numbers, "shard").select(F.col("number").alias("shard"), "n", "front", "back", "keys")
    pairs = _frequent(shards.mapInArrow(_pairs_of_shards, _counted_ddl(2)), 2, least, "frequent-pairs")
    told = _growing(pairs, 2, least)
    triples = shards.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(_triples_of_shard, _counted_ddl(3))
    triples = _frequent(triples, 3, least, "frequent-triples")
    told = told.unionByName(_growing(triples, 3, least))
    fours = count_fours(shards, told)
    fours = fours.groupBy(*_keys(4)).agg(*[F.sum(c).alias(c) for c in _SUMS]).filter(F.col("a") >= least)
    found = _one_row_each(pairs, 2).unionByName(_one_row_each(triples, 3))
    return found.unionByName(fours.select(F.array(*_keys(4)).alias("keys"), *_SUMS))


def count_fours(shards: DataFrame, told: DataFrame) -> DataFrame:
    """Phrases of four words that may be frequent: a row per phrase and group that holds it."""
    told = told.withColumn("shard", group_of(F.col("shard"))).distinct()
    shards = shards.groupBy(group_of(F.col("shard")).alias("group"))
    kinds = ", ".join(f"{c} long" for c in (*_keys(4), *_SUMS))
    return shards.cogroup(told.groupBy("shard")).applyInArrow(_fours_of_group, kinds)


def word_counts(shards: DataFrame) -> DataFrame:
    """Each language's words with their keys and counts. Two words of one key, which are not to be
    expected, would be an error here."""
    each = shards.select("lang", F.explode(F.arrays_zip("keys", "words", "counts")).alias("w"))
    each = each.select("lang", F.col("w.keys").alias("key"), F.col("w.words").alias("word"), F.col("w.counts").alias("f"))
    sums = each.groupBy("key").agg(
        F.min("lang").alias("lang"), F.max("lang").alias("other_lang"), F.min("word").alias("word"), F.max("word").alias("other"), F.sum("f").alias("f")
    )
    one = (F.col("word") == F.col("other")) & (F.col("lang") == F.col("other_lang"))
    return sums.select("key", "lang", F.when(one, F.col("word")).otherwise(F.raise_error(F.lit("two words of one key"))).alias("word"), "f")


def mine(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, first: int = 2000, covered: int = 80
) -> DataFrame:
    """Each language's ``first`` phrases by score: lang, rank, phrase, a, l, r, n, score, n_left, n_right.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and these into words at
    spaces and tabs. Candidates are phrases of 2 to 4 words that occur ``least`` times within pieces
    (``a``, overlaps included). Cut after some word, the parts occur ``l`` and ``r`` times; the score is
    ``floor(2000000 * a / (l + r))`` of the cut where it is lowest, the first of such. A phrase goes if a longer
    candidate around it has at least ``covered`` hundredths of its count. Order: score and count falling,
    then the phrase by bytes. ``n`` counts the language's words; ``n_left`` and ``n_right`` are the occurrences
    with a word before and after them in the piece.

    Null and empty texts have no words; rows without a language are of language ``und``; repeated rows
    count each; further columns are ignored; no rows give no rows.
    """
    shards = materialize(index(docs, text_col, lang_col), "phrase-shards")
    words = materialize(word_counts(shards), "phrase-words")
    counted = materialize(count_phrases(shards, least), "phrase-counts")
    phrases = materialize(_named(counted, words.filter(F.col("f") >= least)), "phrases")
    known = words.select("lang", F.col("word").alias("phrase"), F.col("f")).filter(F.col("f") >= least)
    known = known.unionByName(phrases.select("lang", "phrase", F.col("a").alias("f")))
    scored = _scored(phrases, known)
    around = _longest_around(phrases)
    kept = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | (_wide("most") * 100 < _wide("a") * covered)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "n_left", "n_right"
    )


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def _named(counted: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with their words' texts and their language."""
    places = counted.select("keys", F.posexplode("keys").alias("at", "key"))
    said = places.join(words.select("key", "lang", "word"), "key").groupBy("keys").agg(
        F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("said")
    )
    parts = said.select("keys", "lang", F.transform("said", lambda w: w["word"]).alias("words"))
    return counted.join(parts, "keys").select("lang", "words", F.array_join("words", " ").alias("phrase"), "a", "n_left", "n_right")


def _part(begin: Column, length: Column) -> Column:
    return F.array_join(F.slice("words", begin, length), " ")


def _scored(phrases: DataFrame, known: DataFrame) -> DataFrame:
    """Each phrase with the counts of its parts at the cut of the lowest score."""
    size = F.size("words")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select("lang", "phrase", "a", "n_left", "n_right", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, size - F.col("k")).alias("right"))
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    cuts = cuts.withColumn("both", _wide("l") + _wide("r")).withColumn("many", _wide("a") * 2000000)
    cuts = cuts.withColumn("score", F.expr("many div both"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a", "n_left", "n_right").agg(lowest).select(
        "lang", "phrase", "a", "n_left", "n_right", "cut.l", "cut.r", "cut.score"
    )


def _longest_around(phrases: DataFrame) -> DataFrame:
    """For each phrase within longer ones the largest count of these."""
    size = F.size("words")
    longer = phrases.filter(size > 2).withColumn("length", F.explode(F.sequence(F.lit(2), size - 1)))
    longer = longer.withColumn("begin", F.explode(F.sequence(F.lit(1), size - F.col("length") + 1)))
    parts = longer.select("lang", _part(F.col("begin"), F.col("length")).alias("phrase"), "a")
    return parts.groupBy("lang", "phrase").agg(F.max("a").alias("most"))


SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
  FROM documents),
said AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM said),
grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, i > 1 AS has_left, i + size - 1 < len(w) AS has_right
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE i + size - 1 <= len(w)),
counted AS (
  SELECT lang, size, phrase, count(*) AS f, count_if(has_left) AS n_left, count_if(has_right) AS n_right
  FROM grams GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang),
candidate AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, k, l.f AS l, r.f AS r,
    CAST((2000000::HUGEINT * c.f) // (l.f::HUGEINT + r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate) c
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, array_to_string(w[b:b + m - 1], ' ') AS phrase, max(f) AS most
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS b FROM (SELECT *, unnest(range(2, size)) AS m FROM candidate))
  GROUP BY ALL),
kept AS (
  SELECT c.lang, c.phrase, c.f AS a, s.l, s.r, s.score, c.n_left, c.n_right
  FROM candidate c JOIN scored s USING (lang, phrase) LEFT JOIN around o USING (lang, phrase)
  WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * c.f)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score, n_left, n_right
FROM kept JOIN sizes USING (lang)
QUALIFY rank <= 2000
"""
