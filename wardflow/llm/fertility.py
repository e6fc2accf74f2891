"""Quality rules from what public vocabularies make of a text: tokeniser fertility.

Every distinct word is tokenised once per worker and vocabulary. A document is measured by letters and digits per
token (other marks cost tokens and add none), by the share of tokens that are single bytes (what the
vocabulary has no piece for) and by the evenness of its tokens (their entropy over that of as many
different tokens). A language, or a script where the language is not known, has a band for each, taken
from the exact quartiles of all its documents; documents outside one are rejected.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.arrays import Texts, mixed, ragged, windows
from wardflow.llm.common import map_texts
from wardflow.llm.presplit import PieceCoder
from wardflow.session import materialize

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"
#: A band reaches so many quartile distances beyond the quartiles, and at least so far from the median.
REACH = 3.0
ROOM = {"chars_per_token": 0.15, "byte_share": 0.05, "evenness": 0.10}
#: Measures of fewer tokens say little about a document; the bands widen with this over their root.
SHORT_ROOM = 1.5

BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
MEASURES = {"n_tokens": "bigint", "chars_per_token": "double", "byte_share": "double", "evenness": "double"}
#: In front of the measures by the second vocabulary.
SECOND = "multi_"
#: Measures are rounded to so many places for the quartiles, which bounds how many values there are.
PLACES = 4
#: Words remembered per vocabulary and task.
REMEMBERED = 600_000

#: Leading UTF-8 bytes of letters, by script.
SCRIPTS = {
    "latin": (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)),
    "greek": (0xCD, 0xCE, 0xCF),
    "cyrillic": (0xD0, 0xD1, 0xD2, 0xD3),
    "semitic": (0xD6, 0xD7, 0xD8, 0xD9, 0xDA, 0xDB),
    "asian": tuple(range(0xE3, 0xEE)),
    "other": (*range(0xD4, 0xD6), *range(0xDC, 0xE3)),
}
_SCRIPT_OF = np.zeros(256, np.int64)
for _k, _leads in enumerate(SCRIPTS.values()):
    _SCRIPT_OF[list(_leads)] = _k + 1
#: First bytes of letters and digits; beyond ASCII every character counts.
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC2, 0xF5)]] = True
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def _per_text(weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])
    return sums[starts[1:]] - sums[starts[:-1]]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key whether it occurs again, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    again, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order] = same[:-1] | same[1:]
    before[order] = same[:-1]
    return again, before


def base_counts(flat: Texts, words: tuple[np.ndarray, np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
    owner, start, end = words
    n = flat.count
    prints = flat.fingerprints(start, end)
    own = mixed(np.arange(n, dtype=np.uint64))
    points = np.concatenate([[0], np.cumsum((flat.data & 0xC0) != 0x80, dtype=np.int64)])
    keys, first = windows(prints, owner, WINDOW)
    again, _ = _repeats(keys ^ own[owner[first]])
    cover = np.zeros(len(prints) + 1, np.int64)
    np.add.at(cover, first[again], 1)
    np.add.at(cover, first[again] + WINDOW, -1)
    repeated = np.cumsum(cover[:-1]) > 0

    line_owner, line_start, line_end = flat.runs(flat.data != 0x0A)
    has_word = np.zeros(len(line_start), bool)
    has_word[np.searchsorted(line_start, start, side="right") - 1] = True
    lines = flat.fingerprints(line_start[has_word], line_end[has_word])
    _, before = _repeats(lines ^ own[line_owner[has_word]])
    return {
        "n_words": np.bincount(owner, minlength=n),
        "word_chars": np.bincount(owner, weights=points[end] - points[start], minlength=n).astype(np.int64),
        "n_symbols": _per_text(_IS_SYMBOL[flat.data], flat.starts),
        "n_dup_lines": np.bincount(line_owner[has_word][before], minlength=n),
        "n_repeat_words": np.bincount(owner[repeated], minlength=n),
    }


@dataclass
class Vocabulary:
    """How words become ids, how many ids there are, and which stand for single bytes of other scripts."""

    encode: Callable[[list[str]], list[list[int]]]
    size: int
    is_byte: np.ndarray


def piece_vocabulary(model: bytes) -> Vocabulary:
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = pieces.get_piece_size()
    is_byte = np.array([pieces.is_byte(k) for k in range(size)])
    return Vocabulary(lambda words: pieces.encode(words, num_threads=1), size, is_byte)


def rank_vocabulary(ranks: bytes) -> Vocabulary:
    """From a file of byte strings and ranks; words are taken with a blank in front, as within a text."""
    import public_tokenizers
    import tiktoken

    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    is_byte = np.zeros(max(table.values()) + 1, bool)
    is_byte[[rank for token, rank in table.items() if len(token) == 1 and token[0] >= 0x80]] = True
    return Vocabulary(
        lambda words: [coder.encode_ordinary(f" {word}") for word in words], len(is_byte), is_byte
    )


class Measures:
    """Base counts and fertility of a slice of texts; one per task."""

    def __init__(self, model: bytes, ranks: bytes | None = None):
        self.vocabularies = {"": piece_vocabulary(model)}
        if ranks is not None:
            self.vocabularies[SECOND] = rank_vocabulary(ranks)
        self.coder = PieceCoder(self._encode, REMEMBERED)

    def _encode(self, words: list[str]) -> list[list[int]]:
        """The ids of all vocabularies for each word, those of a later one beyond those of the first."""
        first, *others = self.vocabularies.values()
        found = first.encode(words)
        for other in others:
            found = [a + [first.size + i for i in b] for a, b in zip(found, other.encode(words))]
        return found

    def __call__(self, texts: pa.Array) -> dict[str, pa.Array]:
        flat = Texts(texts)
        words = flat.words()
        found = base_counts(flat, words)
        owner, start, end = words
        where = self.coder.places(flat, start, end)
        sizes = self.coder.sizes[where]
        ids = self.coder.ids[ragged(self.coder.starts[where], sizes)]
        text_of = np.repeat(owner, sizes)
        size = self.vocabularies[""].size
        for name, vocabulary in self.vocabularies.items():
            own, shift = (ids >= size, size) if name else (ids < size, 0)
            measures = self._fertility(vocabulary, flat, text_of[own], ids[own] - shift)
            found |= {f"{name}{k}": v for k, v in measures.items()}
        arrays = {k: pa.array(v, pa.float64() if v.dtype.kind == "f" else pa.int64()) for k, v in found.items()}
        arrays["script"] = pa.array(self._scripts(flat), pa.string())
        return arrays

    def _fertility(
        self, vocabulary: Vocabulary, flat: Texts, text_of: np.ndarray, ids: np.ndarray
    ) -> dict[str, np.ndarray]:
        tokens = np.bincount(text_of, minlength=flat.count)
        in_bytes = np.bincount(text_of[vocabulary.is_byte[ids]], minlength=flat.count)
        return {
            "n_tokens": tokens,
            "chars_per_token": _per_text(_IS_LETTER[flat.data], flat.starts) / np.maximum(tokens, 1),
            "byte_share": in_bytes / np.maximum(tokens, 1),
            "evenness": self._evenness(text_of, ids, tokens, vocabulary.size),
        }

    @staticmethod
    def _evenness(text_of: np.ndarray, ids: np.ndarray, tokens: np.ndarray, size: int) -> np.ndarray:
        keys = np.sort(text_of * size + ids)
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
        counts = np.diff(heads, append=len(keys))
        weighted = np.bincount(
            (keys[heads] // size).astype(np.int64), weights=counts * np.log2(np.maximum(counts, 1)), minlength=len(tokens)
        )
        most = np.log2(np.clip(tokens, 2, size))
        entropy = np.log2(np.maximum(tokens, 1)) - weighted / np.maximum(tokens, 1)
        return np.where(tokens > 1, entropy / most, 1.0)

    @staticmethod
    def _scripts(flat: Texts) -> list[str | None]:
        kinds = _SCRIPT_OF[flat.data]
        owner = np.repeat(np.arange(flat.count), np.diff(flat.starts))
        width = len(SCRIPTS) + 1
        counts = np.bincount(owner * width + kinds, minlength=flat.count * width).reshape(-1, width)[:, 1:]
        names = list(SCRIPTS)
        return [names[k] if row[k] else None for row, k in zip(counts, counts.argmax(axis=1))]


def measure(
    docs: DataFrame, model: bytes, text_col: str = "text", keep: list[str] | None = None, ranks: bytes | None = None
) -> DataFrame:
    """``docs`` with base counts and measures of whole texts (null as empty: no words, evenness 1)."""
    shared = docs.sparkSession.sparkContext.broadcast((model, ranks))
    prefixes = [""] if ranks is None else ["", SECOND]
    columns = ", ".join(f"{prefix}{name} {kind}" for prefix in prefixes for name, kind in MEASURES.items())
    return map_texts(docs, text_col, f"{BASE}, {columns}, script string", lambda: Measures(*shared.value), keep)


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)


def _prefixes(measured: DataFrame) -> list[str]:
    return [prefix for prefix in ("", SECOND) if f"{prefix}n_tokens" in measured.columns]


def bands(measured: DataFrame) -> DataFrame:
    """Per group the quartiles of every measure, over all documents that the base rules pass.

    They are exact for the measures as rounded to ``PLACES``: equal values are counted first, so a group
    is as many rows as it has different values, and the result does not depend on how rows lie.
    """
    names = [f"{prefix}{name}" for prefix in _prefixes(measured) for name in ROOM]
    values = F.array(*[F.struct(F.lit(n).alias("measure"), F.round(n, PLACES).alias("value")) for n in names])
    opened = measured.filter(~base_failed()).select("band_group", F.explode(values).alias("m"))
    counted = opened.groupBy("band_group", "m.measure", "m.value").agg(F.count("*").alias("n"))

    def quartiles(name: str) -> Column:
        value = F.when(F.col("measure") == name, F.col("value"))
        return F.percentile(value, [0.25, 0.5, 0.75], F.col("n")).alias(f"{name}_band")

    return counted.groupBy("band_group").agg(*[quartiles(name) for name in names])


def fertility_rules(
    docs: DataFrame,
    model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    ranks: bytes | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, base counts, measures, ``base_failed``, the ``rejected_by`` list of
    measures outside their band, and ``kept``.

    ``model`` is a piece vocabulary's file, ``ranks`` that of a second one, whose measures have bands of
    their own and names beginning with ``multi_``; a document must meet all.

    The group of a document is its language or, where that is null, its script (a text without letters
    has none and meets no band). Groups without a document that passes the base rules have no band.
    Repeated rows each get their result. A group costs one row per different value and task, whatever
    its size.
    """
    columns = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{lang_col}`").alias("band_lang"),
        F.col(f"`{text_col}`").alias("text"),
    )
    group = F.coalesce("band_lang", F.concat(F.lit("script "), F.col("script")))
    measured = measure(columns, model, keep=["doc_id", "band_lang"], ranks=ranks).withColumn("band_group", group)
    measured = materialize(measured.drop("band_lang"), "fertility")
    return judged(measured, bands(measured))


def judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    limits = limits.withColumnRenamed("band_group", "limit_group")
    # One row per language or script, however many documents there are.
    both = measured.join(F.broadcast(limits), F.col("band_group") == F.col("limit_group"), "left")
    prefixes = _prefixes(measured)
    outside = [_outside(prefix, name) for prefix in prefixes for name in ROOM]
    rejected = F.filter(F.array(*outside), lambda name: name.isNotNull())
    failed = base_failed()
    return both.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.size(rejected) == 0)).alias("kept"),
        *[f"{prefix}{name}" for prefix in prefixes for name in MEASURES],
        "band_group",
        rejected.alias("rejected_by"),
    )


def _outside(prefix: str, name: str) -> Column:
    """The measure's name where it lies outside its band."""
    value = F.col(f"{prefix}{name}")
    low, mid, high = (F.col(f"{prefix}{name}_band")[k] for k in range(3))
    least = F.lit(ROOM[name]) * (mid if name == "chars_per_token" else F.lit(1.0))
    far = F.greatest((high - low) * REACH, least)
    far = far * (1 + SHORT_ROOM / F.sqrt(F.greatest(f"{prefix}n_tokens", F.lit(1))) * 4)
    off = F.abs(value - mid) > far
    if name == "byte_share":
        off = value - mid > far
    if name == "evenness":
        off = mid - value > far
    return F.when(off, F.lit(f"{prefix}{name}"))
