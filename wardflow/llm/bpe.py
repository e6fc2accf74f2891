"""Byte-pair encoding and decoding by a tokenization automaton.

The automaton reads tokens. It starts as one state with an arc for every base symbol. Each merge
(a, b) -> c, in order, is one gadget: the arcs labelled a are led to a copy of their target that
lacks the arc b, and wherever a could be read there is now an arc c to where b led. All arcs with
one label lead to one state, so a merge adds one state and the automaton stays deterministic; in the
end it reads exactly the token sequences that the merges produce. A piece of text is encoded by its
only path whose labels spell the piece, and decoded by putting out the labels.

A state is kept as what its gadget did: whose arcs were redirected, which arc was cut and when. The
cells of the transition table are worked out from that on first use and then looked up.
"""

from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import bounded_batches, map_texts, release_memory
from wardflow.llm.presplit import PieceCoder, Pieces

WORD_END = "</w>"
ENDLESS = 1 << 30
#: Table cells and pieces a worker remembers before it starts over.
CELLS = 300_000
PIECES = 150_000


@dataclass(frozen=True)
class Vocabulary:
    """What the automaton needs of a tokenizer file, small enough to send along with every task."""

    tokens: dict[str, int]
    merges: tuple[tuple[str, str], ...]
    specials: dict[str, int]
    source: str

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            source = file.read()
        return cls.parse(source)

    @classmethod
    @lru_cache(maxsize=2)
    def parse(cls, source: str) -> Vocabulary:
        found = json.loads(source)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in found["model"]["merges"]]
        specials = {t["content"]: t["id"] for t in found["added_tokens"]}
        return cls(found["model"]["vocab"], tuple(map(tuple, pairs)), specials, source)

    def splitting(self) -> str:
        """The tokenizer file with its normalizer and its splitting, but without tokens and merges."""
        found = json.loads(self.source)
        found["model"] |= {"vocab": {}, "merges": [], "unk_token": None}
        return json.dumps(found | {"added_tokens": [], "post_processor": None, "truncation": None, "padding": None})

    def labels(self) -> list[str]:
        every = self.tokens | self.specials
        names = [""] * (max(every.values()) + 1)
        for name, number in every.items():
            names[number] = name
        return names


class Automaton:
    def __init__(self, vocabulary: Vocabulary):
        ids = vocabulary.tokens
        size = max(ids.values()) + 1
        self.left, self.right = [-1] * size, [-1] * size
        self.born = [-1] * size  # when the gadget of the token was built; base symbols: before all
        self.cut: dict[int, int] = {}  # (owner of the redirected arcs, label of the cut arc) -> when
        made = {a + b for a, b in vocabulary.merges}
        self.arcs = {name: number for name, number in ids.items() if name not in made}
        self.cells: dict[int, bool] = {}
        for when, (a, b) in enumerate(vocabulary.merges):
            self._add_gadget(ids[a], ids[b], ids[a + b], a + b, when)
        self.longest = max(len(name.removesuffix(WORD_END)) for name in self.arcs)

    def _add_gadget(self, a: int, b: int, c: int, name: str, when: int) -> None:
        if name in self.arcs or not self._arc(a, b):
            return  # made before, or b can't be read after a: no arc can ever carry the label
        self.left[c], self.right[c], self.born[c] = a, b, when
        self.arcs[name] = c
        self.cut[a << 20 | b] = when

    def _arc(self, last: int, label: int) -> bool:
        """Whether the state behind ``last`` has an arc ``label``.

        That state goes back to the ones behind the right parts of ``last``, as they were when it
        was copied from them; the arc goes back to the left parts of ``label`` likewise.
        """
        cut, left, right, born = self.cut, self.left, self.right, self.born
        copied = ENDLESS
        while last >= 0:
            part, grown = label, ENDLESS
            while part >= 0:
                when = cut.get(last << 20 | part)
                if when is not None and when < copied and when <= grown:
                    return False
                part, grown = left[part], born[part]
            last, copied = right[last], born[last]
        return True

    def steps(self, last: int, label: int) -> bool:
        """The cell of the transition table."""
        if last < 0:
            return True
        key = last << 20 | label
        found = self.cells.get(key)
        if found is None:
            if len(self.cells) > CELLS:
                self.cells.clear()
            found = self.cells[key] = self._arc(last, label)
        return found

    def encode(self, piece: str) -> list[int]:
        """The labels on the only path that spells ``piece``; longer arcs are tried first."""
        size, arcs, longest, steps = len(piece), self.arcs, self.longest, self.steps
        path: list[int] = []
        ends: list[int] = [0]
        following = min(size, longest)
        while ends[-1] < size:
            at, last = ends[-1], path[-1] if path else -1
            end = following
            while end > at:
                name = piece[at:end] + WORD_END if end == size else piece[at:end]
                label = arcs.get(name)
                if label is not None and steps(last, label):
                    break
                end -= 1
            if end > at:
                path.append(label)
                ends.append(end)
                following = min(size, end + longest)
            elif path:
                path.pop()
                following = ends.pop() - 1
            else:
                raise ValueError(f"no path for {piece!r}")
        return path


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    codes = {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}
    return [chr(codes[b]) for b in range(256)]


_LETTERS = {b: letter for b, letter in enumerate(byte_letters())}


class WordEncoder:
    """Whole texts to ids as the vocabulary's library does it, one per task."""

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.automaton = Automaton(vocabulary)
        self.coder = PieceCoder(self._encode_pieces, PIECES)
        self.specials = vocabulary.specials
        names = sorted(map(re.escape, self.specials), key=len, reverse=True)
        self.special_pattern = re.compile("|".join(names)) if names else None
        # Only to split unusual texts, for which it needs no tokens.
        self.library = Tokenizer.from_str(vocabulary.splitting())

    def _encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        encode, letters = self.automaton.encode, _LETTERS
        return [encode("".join(map(letters.__getitem__, p.encode()))) for p in pieces]

    @staticmethod
    def _normal(text: str) -> str:
        # One letter at a time: lower() alone would turn a word's last capital sigma into another.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _unusual(self, text: str) -> list[int]:
        """Texts with special strings or unsettled code points: the library splits, the automaton encodes."""
        ids: list[int] = []

        def plain(part: str) -> None:
            if part:
                normal = self.library.normalizer.normalize_str(part)
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                    ids.extend(self.automaton.encode(piece))

        at = 0
        for found in self.special_pattern.finditer(text) if self.special_pattern else ():
            plain(text[at : found.start()])
            ids.append(self.specials[found.group()])
            at = found.end()
        plain(text[at:])
        return ids

    def __call__(self, texts: pa.Array) -> pa.Array:
        strings = texts.to_pylist()
        pieces = Pieces([self._normal(s) for s in strings])
        ids, sizes = self.coder.code(pieces, *pieces.word_level())
        unusual = set(pieces.unsettled.tolist())
        # A special string has a "<|" in it, whatever its name.
        for k, text in enumerate(strings):
            if k not in unusual and self.special_pattern and self.special_pattern.search(text):
                unusual.add(k)
        raw = Pieces(strings).unsettled if unusual else ()
        unusual.update(np.asarray(raw, dtype=np.int64).tolist())
        if unusual:
            parts = np.split(ids, np.cumsum(sizes)[:-1])
            for k in unusual:
                parts[k] = np.asarray(self._unusual(strings[k]), np.int32)
                sizes[k] = len(parts[k])
            ids = np.concatenate(parts).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def encode(
    docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", into: str = "ids"
) -> DataFrame:
    """``docs`` with the token ids of whole texts, an array column ``into``.

    Null and empty texts have no ids. Special strings of the vocabulary found in a text get their own
    ids. A column named ``into`` is replaced; all others stay, repeated rows too. No row leaves its
    partition; a task holds one slice of texts, the vocabulary and bounded memories of what it has seen.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.source)

    def compute():
        encoder = WordEncoder(Vocabulary.parse(shared.value))
        return lambda texts: {into: encoder(texts)}

    return map_texts(docs, text_col, f"`{into}` array<int>", compute)


def decode(
    docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", into: str = "decoded"
) -> DataFrame:
    """``docs`` with the labels of their ids, one space between them, as column ``into``.

    Nothing for no ids, null for null; an id that the vocabulary lacks fails the job.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.source)
    kept = [c for c in docs.columns if c != into]
    source = docs.select(*kept, F.col(ids_col).alias("_ids"))
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(into, T.StringType())])

    def run(batches):
        labels = Vocabulary.parse(shared.value).labels()
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            texts = [
                None if not k.is_valid else " ".join(map(labels.__getitem__, k.values.to_numpy().tolist()))
                for k in lists
            ]
            columns = [batch.column(c) for c in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*kept, into])
        release_memory()

    return source.mapInArrow(run, schema)
