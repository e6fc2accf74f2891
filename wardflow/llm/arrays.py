"""Whole batches of texts as flat numpy arrays, for use inside tasks.

A batch of Arrow strings is one block of UTF-8 bytes plus offsets. Words, lines and windows of words
are ranges of that block, and the fingerprint of any range follows from two prefix sums, so no step
here loops over words. Fingerprints are 64 bits of a polynomial over a fixed random value per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a single longer text is handled alone.
SLICE_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240607)
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[list(BLANKS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the 64-bit input; a bijection."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse, as many as the longest slice so far needed."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = 1 << int(n).bit_length()
            if size > 16 * SLICE_BYTES:  # a huge text: not kept
                return _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)
        return self.up, self.down


def _powers(base: np.uint64, n: int) -> np.ndarray:
    found = np.ones(n, dtype=np.uint64)
    have, step = 1, base
    while have < n:
        more = min(have, n - have)
        found[have : have + more] = found[:more] * step
        have += more
        step = np.uint64(int(step) ** 2 & 0xFFFFFFFFFFFFFFFF)
    return found


_KEPT_POWERS = _Powers()


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch with a bounded amount of text, and the text of each with nulls as empty."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(starts, starts[begin] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield batch.slice(begin, end - begin), texts.slice(begin, end - begin)
        begin = end


class Texts:
    """The bytes of some texts back to back; text i is ``data[starts[i]:starts[i + 1]]``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        self.data = data[offsets[0] : offsets[-1]]
        if lower:
            self.data = LOWER[self.data]
        self.starts = offsets - offsets[0]
        self.count = len(texts)
        self._sums: np.ndarray | None = None

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal ranges of marked bytes that stay within one text: text, start, end."""
        n = len(inside)
        before = np.zeros(n + 1, dtype=bool)
        before[1:] = inside
        cuts = self.starts[(self.starts > 0) & (self.starts < n)]
        opens = inside & ~before[:-1]
        opens[cuts] = inside[cuts]
        closes = before[1:].copy()
        closes[:-1] &= ~inside[1:] if n > 1 else True
        closes[cuts - 1] = inside[cuts - 1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        return self.owner(start), start, end

    def owner(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1

    def string(self, start: int, end: int) -> str:
        return self.data[start:end].tobytes().decode("utf-8", "replace")

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of bytes that are not blank."""
        return self.runs(~IS_BLANK[self.data])

    def fingerprints(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64 bits for every range; the length takes part."""
        up, down = _KEPT_POWERS.upto(len(self.data))
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(_BYTE_VALUES[self.data] * up[: len(self.data)], out=self._sums[1:])
        value = (self._sums[end] - self._sums[start]) * down[start]
        return mixed(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def windows(
    values: np.ndarray, owner: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of every window of ``width`` consecutive values of one owner, and its first place."""
    if len(values) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = len(values) - width + 1
    sums = np.zeros(last, dtype=np.uint64)
    for k in range(width):
        sums = sums * np.uint64(0xC2B2AE3D27D4EB4F) + values[k : k + last]
    first = np.flatnonzero(owner[:last] == owner[width - 1 :])
    return mixed(sums[first]), first


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the concatenated ranges ``starts[i] … starts[i] + lengths[i]``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def bounds(owner: np.ndarray, count: int) -> np.ndarray:
    """For sorted owners: where each of ``count`` owners begins, and the end."""
    return np.searchsorted(owner, np.arange(count + 1))


@lru_cache(maxsize=1)
def letter_kinds() -> tuple[np.ndarray, np.ndarray]:
    """By code point: 0 other, 1 letter, 2 number, 3 white space; and whether that is long settled.

    Settled code points had the same category in Unicode 3.2; of all others, different libraries may
    think differently. The planes with few or no characters are left unsettled as a whole.
    """
    import sys
    import unicodedata

    size = sys.maxunicode + 1
    kind, settled = np.zeros(size, np.uint8), np.zeros(size, bool)
    old, new = unicodedata.ucd_3_2_0.category, unicodedata.category
    for code in range(0x30000):
        char = chr(code)
        now = new(char)
        settled[code] = now == old(char) and now != "Cn"
        kind[code] = {"L": 1, "N": 2}.get(now[0], 0)
    kind[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]] = 3
    kind[[0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = 3
    return kind, settled
