"""A two-way FM-index over word numbers, in numpy, for phrases up to a fixed length.

The text is a sequence of word numbers from 1, with 0 before, between and after pieces. Its suffixes, and
those of its reverse, are sorted by their first ``DEPTH`` numbers; a phrase is a range of rows in each of
the two orders. The numbers in front of a range's rows (the BWT) are the words by which the phrase can be
extended to that side, and how many of them are smaller gives the range of the longer phrase on the other
side, so that a phrase grows both ways without the text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

from wardflow.llm.arrays import ragged

#: Longest phrase.
DEPTH = 4


def bwt(sequence: np.ndarray) -> np.ndarray:
    """For each suffix, in order of its first ``DEPTH`` numbers, the number in front of it."""
    n = len(sequence)
    longer = np.zeros(n + DEPTH, np.int64)
    longer[:n] = sequence
    pair = _ranks(longer[: n + 2] * (int(sequence.max(initial=0)) + 1) + longer[1 : n + 3])
    order = np.argsort(pair[:n] * (int(pair.max()) + 1) + pair[2 : n + 2])
    return sequence[order - 1]  # in front of the first stands the last, a 0 like it


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def packed(values: np.ndarray) -> bytes:
    """Numbers by planes of bytes, of which the higher ones are mostly zeros, compressed."""
    planes = np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<i4").reshape(n)


class Side:
    """One BWT with what its rows' ranks need."""

    def __init__(self, front: np.ndarray):
        self.front = front
        self.edges = np.concatenate([[0], np.cumsum(front == 0)])

    @cached_property
    def next(self) -> np.ndarray:
        """Of row i with number c in front: where c's rows begin, plus how many c stand before i."""
        order = np.argsort(self.front, kind="stable")
        found = np.empty(len(order), np.int64)
        found[order] = np.arange(len(order))
        return found

    def ends(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How many rows of each range stand at an end of their piece."""
        return self.edges[low + size] - self.edges[low]


@dataclass
class Phrases:
    """Phrases of one length: their words, and their ranges in the text's and in its reverse's order."""

    words: np.ndarray
    low: np.ndarray
    low_back: np.ndarray
    size: np.ndarray

    def __len__(self) -> int:
        return len(self.size)

    def only(self, chosen: np.ndarray) -> Phrases:
        return Phrases(self.words[chosen], self.low[chosen], self.low_back[chosen], self.size[chosen])


def single(front: np.ndarray) -> Phrases:
    """All words as phrases. The order of single numbers is the same both ways."""
    counts = np.bincount(front, minlength=1)
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
    words = np.flatnonzero(counts[1:]) + 1
    return Phrases(words[:, None], begins[words], begins[words], counts[words])


def _extended(side: Side, low: np.ndarray, low_other: np.ndarray, size: np.ndarray):
    """All extensions of ranges by what stands in front: owner, word, range here, range there, size."""
    rows = ragged(low, size)
    owner = np.repeat(np.arange(len(size)), size)
    front = side.front[rows]
    order = np.argsort(owner * (int(front.max(initial=0)) + 1) + front, kind="stable")
    owner, front = owner[order], front[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(owner) != 0) | (np.diff(front) != 0)
    begins = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([begins, [len(order)]]))
    # The sort is stable and rows ascend, so the first of a group is its first row.
    here = side.next[rows[order[begins]]]
    owner, front = owner[begins], front[begins]
    there = low_other[owner] + begins - (np.cumsum(size) - size)[owner]
    real = front > 0
    return owner[real], front[real], here[real], there[real], sizes[real]


def extend_left(side: Side, phrases: Phrases) -> Phrases:
    """Every phrase with every word that stands before it."""
    owner, word, low, back, size = _extended(side, phrases.low, phrases.low_back, phrases.size)
    return Phrases(np.concatenate([word[:, None], phrases.words[owner]], axis=1), low, back, size)


def extend_right(side: Side, phrases: Phrases) -> Phrases:
    """Every phrase with every word that stands after it; ``side`` is that of the reverse."""
    owner, word, back, low, size = _extended(side, phrases.low_back, phrases.low, phrases.size)
    return Phrases(np.concatenate([phrases.words[owner], word[:, None]], axis=1), low, back, size)


def within(low: np.ndarray, outer_low: np.ndarray, outer_size: np.ndarray) -> np.ndarray:
    """Which ranges lie in one of the outer ranges, which do not overlap."""
    if not len(outer_low):
        return np.zeros(len(low), bool)
    order = np.argsort(outer_low)
    starts, ends = outer_low[order], (outer_low + outer_size)[order]
    at = np.searchsorted(starts, low, side="right") - 1
    return (at >= 0) & (low < ends[np.maximum(at, 0)])
