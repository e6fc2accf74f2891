"""Re-Pair: frequent pairs of ids become symbols of their own, within a shard of many documents.

Every round counts the pairs of neighbours, gives the frequent ones new symbols and replaces them
from left to right. Pairs never reach across the end of a document, so each document can be decoded
without the others. Symbols fit 16 bits; the rules and the length each of them expands to are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from wardflow.llm.arrays import ragged

SYMBOLS = 1 << 16
ROUNDS = 4
#: New symbols per round, and how often a pair must occur to get one.
PER_ROUND = 3500
LEAST = 24

_TABLE_BITS = 18


@dataclass
class Grammar:
    """Rule k makes symbol ``base + k`` stand for ``left[k], right[k]``, ``length[k]`` ids in all."""

    base: int
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray

    def expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All expansions back to back, and by symbol where its one starts and how long it is."""
        lengths = np.concatenate([np.ones(self.base, np.int64), self.length.astype(np.int64)])
        starts = np.cumsum(lengths) - lengths
        flat = np.empty(int(lengths.sum()), np.int32)
        flat[: self.base] = np.arange(self.base)
        for k, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist())):
            at, half = starts[self.base + k], lengths[a]
            flat[at : at + half] = flat[starts[a] : starts[a] + half]
            flat[at + half : at + lengths[self.base + k]] = flat[starts[b] : starts[b] + lengths[b]]
        return flat, starts, lengths

    def expand(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids that ``symbols`` stand for, and how many ids each of them gives."""
        flat, starts, lengths = self.expansions()
        sizes = lengths[symbols]
        return flat[ragged(starts[symbols], sizes)], sizes


def compress(ids: np.ndarray, sizes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, Grammar]:
    """The symbols (16 bits) of documents with ``sizes`` ids each, how many each document has, and the rules.

    ``base`` is the first number that no id uses.
    """
    symbols = ids.astype(np.uint16)
    last = np.zeros(len(ids) + 1, dtype=bool)
    ends = np.cumsum(sizes)
    last[ends[sizes > 0] - 1] = True
    last = last[: len(ids)]
    left, right = np.zeros(0, np.uint16), np.zeros(0, np.uint16)
    length = np.ones(base, np.int64)
    for _ in range(ROUNDS):
        room = min(PER_ROUND, SYMBOLS - base - len(left))
        pairs = _frequent(symbols, last, room)
        if not len(pairs):
            break
        symbols, last = _replace(symbols, last, pairs, base + len(left))
        a, b = (pairs >> np.uint32(16)).astype(np.uint16), (pairs & np.uint32(0xFFFF)).astype(np.uint16)
        length = np.concatenate([length, length[a] + length[b]])
        left, right = np.concatenate([left, a]), np.concatenate([right, b])
    counts = np.zeros(len(sizes), np.int64)
    counts[sizes > 0] = np.diff(np.flatnonzero(last), prepend=-1)
    return symbols, counts, Grammar(base, left, right, length[base:])


def _keys(symbols: np.ndarray) -> np.ndarray:
    return symbols[:-1].astype(np.uint32) << np.uint32(16) | symbols[1:]


def _slot(keys: np.ndarray) -> np.ndarray:
    return keys * np.uint32(0x9E3779B1) >> np.uint32(32 - _TABLE_BITS)


def _frequent(symbols: np.ndarray, last: np.ndarray, room: int) -> np.ndarray:
    """The most frequent pairs, each with a slot of its own in the replacing table."""
    if len(symbols) < 2 or room < 1:
        return np.zeros(0, np.uint32)
    keys = np.sort(_keys(symbols)[~last[:-1]])
    if not len(keys):
        return keys
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(heads, append=len(keys))
    often = np.flatnonzero(counts >= LEAST)
    best = often[np.argsort(-counts[often], kind="stable")[:room]]
    pairs = keys[heads[best]]
    _, own = np.unique(_slot(pairs), return_index=True)
    return pairs[np.sort(own)]


def _replace(
    symbols: np.ndarray, last: np.ndarray, pairs: np.ndarray, first: int
) -> tuple[np.ndarray, np.ndarray]:
    table = np.full(1 << _TABLE_BITS, -1, np.int32)
    table[_slot(pairs)] = np.arange(len(pairs))
    keys = _keys(symbols)
    rule = table[_slot(keys)]
    hit = (rule >= 0) & ~last[:-1]
    places = np.flatnonzero(hit)
    places = places[pairs[rule[places]] == keys[places]]
    # Of hits that overlap, every other one counts, from the left.
    heads = np.concatenate([[True], np.diff(places) > 1])
    runs = np.flatnonzero(heads)
    within = np.arange(len(places)) - np.repeat(runs, np.diff(runs, append=len(places)))
    places = places[within % 2 == 0]
    changed = symbols.copy()
    changed[places] = (first + rule[places]).astype(np.uint16)
    stays = np.ones(len(symbols), dtype=bool)
    stays[places + 1] = False
    ends = last.copy()
    ends[places] = last[places + 1]
    return changed[stays], ends[stays]
