"""Plain single-process versions of the operators, for comparison."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def spark_hash(data: bytes, seed: int = 42) -> int:
    return signed(xxhash.xxh64(data, seed=seed & (2**64 - 1)).intdigest())


def shard_of(doc_id: int | None, shards: int) -> int:
    start = 42 if doc_id is None else spark_hash(struct.pack("<q", doc_id))
    return max(range(shards), key=lambda s: (spark_hash(struct.pack("<i", s), start), -s))


def op1(rows):
    found = Counter()
    for doc_id, text in rows:
        data = (text or "").encode()
        shard, grown = shard_of(doc_id, 40), shard_of(doc_id, 41)
        found[(doc_id, len(data) + 16, zlib.crc32(data), "key", shard, grown)] += 1
    return found


def op2(rows):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = Counter()
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        found[(doc_id, len(ids), sha(" ".join(map(str, ids))), sha(decoded))] += 1
    return found


def op3(rows):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    found, start = Counter(), 0
    for doc_id, text in order:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(b"".join(struct.pack("<I", i) for i in ids))
        found[(doc_id, start, len(ids), crc)] += 1
        start += len(ids)
    return found


def op4_base(rows):
    found = Counter()
    for doc_id, text in rows:
        text = text or ""
        words = WORD.findall(text)
        grams = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        repeated = {k + j for k in range(len(words) - 4) if grams[tuple(words[k : k + 5])] > 1 for j in range(5)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        found[
            (
                doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                len(lines) - len(set(lines)), len(repeated), failed,
            )
        ] += 1
    return found


def shingles(text: str | None, width: int) -> frozenset:
    words = WORD.findall((text or "").translate(SMALL))
    if len(words) >= width:
        return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def op5(rows, width=4):
    sets = [shingles(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = defaultdict(list)
    for k, found in enumerate(sets):
        common = Counter(j for x in found for j in holders[x])
        for j, n in common.items():
            if 100 * n >= 80 * (len(found) + len(sets[j]) - n):
                a, b = root(k), root(j)
                parent[max(a, b)] = min(a, b)
        for x in found:
            holders[x].append(k)
    lowest = {}
    for k, (doc_id, _) in enumerate(rows):
        ids = [i for i in (lowest.get(root(k)), doc_id) if i is not None]
        lowest[root(k)] = min(ids) if ids else None
    return Counter(
        (doc_id, len(sets[k]), lowest[root(k)], doc_id == lowest[root(k)]) for k, (doc_id, _) in enumerate(rows)
    )


def chunks(text: str) -> list[tuple[int, int, str]]:
    lines = text.split("\n")
    hashes = [spark_hash(line.encode()) for line in lines]
    starts = []
    for i in range(len(lines)):
        edge = i == 0 or lines[i].count(" ") >= 50 or lines[i - 1].count(" ") >= 50
        if not edge:
            first = spark_hash(struct.pack("<q", hashes[i - 1]))
            edge = spark_hash(struct.pack("<q", hashes[i - 2] if i > 1 else 0), first) % 3 == 0
        if edge:
            starts.append(i)
    return [(a, b - a, "\n".join(lines[a:b])) for a, b in zip(starts, [*starts[1:], len(lines)])]


def op6(rows):
    """Rows must have ids, each once."""
    seen, found = set(), Counter()
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        cut = chunks(text or "") if text is not None else []
        said = [c for c in cut if re.search(r"\S", c[2], re.ASCII)]
        late = set()
        for at, _, body in said:
            if body in seen:
                late.add(at)
            seen.add(body)
        if len(late) < len(said):
            late = {a for a, n, b in said if a in late and (n > 1 or b.count(" ") >= 50)}
        kept = "\n".join(b for a, _, b in cut if a not in late)
        found[(doc_id, len(late), sum(n for a, n, _ in cut if a in late), len(kept.encode()), sha(kept))] += 1
    return found
