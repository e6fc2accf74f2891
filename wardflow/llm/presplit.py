"""Splitting texts into the pieces that byte-pair merges never cross, and coding each distinct piece once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

from wardflow.llm.arrays import SLICE_BYTES, _powers, letter_kinds, mixed, ragged

LETTER, NUMBER, SPACE = 1, 2, 3
#: Endings that stay with their apostrophe (fixed values of the public patterns).
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")

_BASE = np.uint64(0xD1342543DE82EF95)
_UP = [np.ones(1, np.uint64)]
_DOWN = [np.ones(1, np.uint64)]
_CODE_VALUES = mixed(np.arange(1, 0x110002, dtype=np.uint64)) | np.uint64(1)


class Pieces:
    """Texts back to back as code points, cut into pieces."""

    def __init__(self, texts: Sequence[str]):
        self.joined = "".join(texts)
        self.codes = np.frombuffer(self.joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        kinds, settled = letter_kinds()
        self.kinds = kinds[self.codes]
        odd = np.flatnonzero(~settled[self.codes])
        #: Texts with code points that libraries may class differently.
        self.unsettled = np.unique(np.searchsorted(self.starts, odd, side="right") - 1)

    def _marks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where runs of one kind begin; and of every run its start, end and whether it ends a text."""
        n = len(self.codes)
        marks = np.ones(n + 1, dtype=bool)
        marks[1:n] = self.kinds[1:] != self.kinds[:-1]
        marks[self.starts] = True
        places = np.flatnonzero(marks)
        start, end = places[:-1], places[1:]
        last = np.zeros(n + 1, dtype=bool)
        last[self.starts] = True
        return marks, start, end, last[end]

    def _join_endings(self, marks, start, end, last, alone: np.ndarray) -> None:
        """Lone apostrophes take a short ending from the letters behind them."""
        codes = self.codes
        quote = np.flatnonzero(alone & (end - start == 1) & ~last)
        quote = quote[codes[start[quote]] == 0x27]
        quote = quote[self.kinds[end[quote]] == LETTER]
        at, room = end[quote], end[quote + 1] - end[quote]
        taken = np.isin(codes[at], [ord(c) for c in SHORT_ENDINGS]).astype(np.int64)
        two = np.flatnonzero((taken == 0) & (room >= 2))
        for ending in LONG_ENDINGS:
            first, second = map(ord, ending)
            hit = (codes[at[two]] == first) & (codes[at[two] + 1] == second)
            taken[two[hit]] = 2
        hit = taken > 0
        marks[at[hit]] = False
        marks[at[hit] + taken[hit]] = True

    def byte_level(self) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of the pattern in which a space belongs to what follows it; they tile the texts."""
        marks, start, end, last = self._marks()
        if not len(start):
            return start, end
        kinds = self.kinds[start]
        spaces = np.flatnonzero((kinds == SPACE) & ~last)
        marks[end[spaces] - 1] = True
        attached = self.codes[end[spaces] - 1] == 0x20
        marks[end[spaces[attached]]] = False
        free = np.ones(len(start), dtype=bool)
        free[spaces[attached] + 1] = False
        self._join_endings(marks, start, end, last, (kinds == 0) & free)
        places = np.flatnonzero(marks)
        return places[:-1], places[1:]

    def word_level(self) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of the pattern without white space, each number a piece of its own."""
        marks, start, end, last = self._marks()
        if not len(start):
            return start, end
        marks[:-1] |= self.kinds == NUMBER
        self._join_endings(marks, start, end, last, self.kinds[start] == 0)
        places = np.flatnonzero(marks)
        begin, stop = places[:-1], places[1:]
        seen = self.kinds[begin] != SPACE
        return begin[seen], stop[seen]

    def fingerprints(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(self.codes)
        up, down = _UP[0], _DOWN[0]
        if len(up) <= n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            size = max(n, SLICE_BYTES) + 1
            up, down = _powers(_BASE, size), _powers(inverse, size)
            if n <= SLICE_BYTES:  # those of a huge text are not kept
                _UP[0], _DOWN[0] = up, down
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODE_VALUES[self.codes] * up[:n], out=sums[1:])
        value = (sums[end] - sums[start]) * down[start]
        return mixed(value + (end - start).astype(np.uint64))

    def string(self, start: int, end: int) -> str:
        return self.joined[start:end]


class PieceCoder:
    """Codes pieces through ``encode``, a function from distinct strings to id lists, remembering them.

    The memory is emptied when it holds ``limit`` pieces, so a task stays bounded whatever it reads.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 1_200_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        #: Fingerprints of the pieces in ascending order, and the number of each.
        self.known = np.zeros(0, np.uint64)
        self.numbers = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 20, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 18, np.int64)
        self.sizes = np.zeros(1 << 18, np.int64)

    def _learn(self, keys: np.ndarray, before: np.ndarray, lists: list[list[int]]) -> None:
        """Take in new ``keys``, which ascend; ``before`` is where each belongs among the known."""
        count, total = len(self.known), sum(map(len, lists))
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while count + len(keys) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, total)
        self.ids[self.used : self.used + total] = flat
        self.starts[count : count + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[count : count + len(keys)] = sizes
        self.known = np.insert(self.known, before, keys)
        self.numbers = np.insert(self.numbers, before, np.arange(count, count + len(keys)))
        self.used += total

    def places(self, pieces: Pieces, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For every piece the number under which its ids are kept in ``starts`` and ``sizes``."""
        if len(self.known) > self.limit:
            self._clear()
        prints = pieces.fingerprints(start, end)
        distinct, first, which = np.unique(prints, return_index=True, return_inverse=True)
        before = np.searchsorted(self.known, distinct)
        absent = np.ones(len(distinct), bool)
        inside = before < len(self.known)
        absent[inside] = self.known[before[inside]] != distinct[inside]
        if absent.any():
            at = first[absent]
            strings = [pieces.string(s, e) for s, e in zip(start[at].tolist(), end[at].tolist())]
            self._learn(distinct[absent], before[absent], self.encode(strings))
            before = np.searchsorted(self.known, distinct)
        return self.numbers[before][which]

    def code(
        self, pieces: Pieces, start: np.ndarray, end: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text of ``pieces`` has."""
        where = self.places(pieces, start, end)
        sizes = self.sizes[where]
        ids = self.ids[ragged(self.starts[where], sizes)]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        cut = np.searchsorted(start, pieces.starts)
        return ids, np.diff(upto[cut])
