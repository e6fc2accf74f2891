"""Phrases against a plain version, and the index against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import SMALL
from wardflow.llm import collocations, fm_index


def plain(rows, least=30, first=2000, covered=80):
    """``rows``: text, language."""
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for k in range(len(words) - size + 1):
                    counts[lang][tuple(words[k : k + size])] += 1
    found = Counter()
    for lang, count in counts.items():
        rows = []
        many = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in many.items():
            for size in range(2, len(p)):
                for k in range(len(p) - size + 1):
                    around[p[k : k + size]] = max(around[p[k : k + size]], a)
        for p, a in many.items():
            if 100 * around[p] >= covered * a:
                continue
            score, _, l, r = min(
                (2000000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p))
            )
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:first], 1):
            found[(lang, rank, phrase.decode(), -a, l, r, n[lang], -score)] += 1
    return found


def odd_rows():
    draw = random.Random(3)
    words = "the of A a.b être Straße ΣΑΣ don't 日本 x\x85y \x1c x　z".split(" ")

    def text(n):
        return "".join(draw.choice(words) + draw.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", "\x0b"]) for _ in range(n))

    rows = [(text(draw.randrange(0, 60)), draw.choice(["en", "de", None, "und", ""])) for _ in range(300)]
    rows += [(None, "en"), ("", "fr"), (" \t\n..", "fr"), ("the of " * 4000, "en"), ("q" * 100_000, "de"), ("one", "it")]
    rows += [("New York City hall is open", "en")] * 40 + [("New York is big", "en")] * 5
    return rows


def as_docs(spark, rows, parts):
    kinds = "text string, lang string, shard string, phrase int, n string, word string, keys int"
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2) for r in rows], kinds).repartition(parts)


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_rows(spark, parts):
    rows = odd_rows()
    found = collocations.mine(as_docs(spark, rows, parts)).drop("n_left", "n_right").collect()
    assert Counter(tuple(r) for r in found) == plain(rows)


def test_other_settings(spark):
    rows = odd_rows()
    found = collocations.mine(as_docs(spark, rows, 3), least=3, first=15, covered=50).drop("n_left", "n_right").collect()
    assert Counter(tuple(r) for r in found) == plain(rows, 3, 15, 50)


def test_many_groups_of_shards(spark, monkeypatch):
    monkeypatch.setattr(collocations, "GROUP_WORDS", 1500)
    rows = odd_rows()
    found = collocations.mine(as_docs(spark, rows, 7), least=3).drop("n_left", "n_right").collect()
    assert Counter(tuple(r) for r in found) == plain(rows, 3)


def test_shards_of_a_language_in_groups(spark, monkeypatch):
    monkeypatch.setattr(collocations, "GROUP_WORDS", 100)
    draw = random.Random(5)
    rows = [(k << 32 | k % 3, draw.choice("ab"), draw.choice([1, 30, 60, 99, 100, 350])) for k in range(60)]
    numbers = collocations.shard_numbers(spark.createDataFrame(rows, "shard long, lang string, n long"))
    assert numbers.select("number").distinct().count() == 60
    found = dict(numbers.select("shard", collocations.group_of(F.col("number"))).collect())
    assert set(found) == {shard for shard, _, _ in rows}
    held = defaultdict(list)
    for shard, lang, n in sorted(rows):
        held[found[shard]].append((shard, lang, n))
    for shards in held.values():
        assert len({lang for _, lang, _ in shards}) == 1
        assert sum(n for _, _, n in shards[:-1]) < 100
    assert max(map(len, held.values())) > 1 and len(held) > 10


def test_fours_leave_a_group_once(spark, monkeypatch):
    """However many shards hold a phrase of four words, a group of them counts it in one row."""
    made, count_fours = [], collocations.count_fours
    monkeypatch.setattr(collocations, "count_fours", lambda *a: made.append(count_fours(*a)) or made[-1])
    rows = [(f"one two three four five {k % 9}", lang) for lang in ("en", "de") for k in range(240)]
    found = collocations.mine(as_docs(spark, rows, 12)).drop("n_left", "n_right").collect()
    assert Counter(tuple(r) for r in found) == plain(rows)
    sums = Counter(tuple(r)[:4] for r in made[0].collect())
    assert len(sums) >= 4 and set(sums.values()) == {1}


def test_no_words(spark):
    assert collocations.mine(as_docs(spark, [(None, "en"), ("", None), (" .. ", "x")], 1)).collect() == []
    assert collocations.mine(as_docs(spark, odd_rows(), 1).filter("false")).collect() == []


def test_nothing_frequent(spark):
    assert collocations.mine(as_docs(spark, [("a b c d e f", "en")], 1)).collect() == []


def plain_counts(sequence, size):
    found = Counter()
    for k in range(len(sequence) - size + 1):
        part = tuple(sequence[k : k + size])
        if 0 not in part:
            found[part] += 1
    return found


def as_counts(phrases):
    return {tuple(w): s for w, s in zip(phrases.words.tolist(), phrases.size.tolist(), strict=True)}


@pytest.mark.parametrize("seed", range(6))
def test_index_grows_phrases_both_ways(seed):
    draw = np.random.default_rng(seed)
    sequence = draw.integers(0, 2 + 3 * seed, 400).astype(np.int32)
    sequence[[0, -1]] = 0
    front, back = (fm_index.Side(fm_index.bwt(s)) for s in (sequence, sequence[::-1]))
    phrases = fm_index.single(front.front)
    assert as_counts(phrases) == plain_counts(sequence, 1)
    for size, left in ((2, True), (3, False), (4, True)):
        phrases = fm_index.extend_left(front, phrases) if left else fm_index.extend_right(back, phrases)
        assert as_counts(phrases) == plain_counts(sequence, size)
    text = "".join(map(chr, sequence + 97))
    for word, low, back_low, n in zip(phrases.words, phrases.low, phrases.low_back, phrases.size):
        said = "".join(map(chr, word + 97))
        places = [k for k in range(len(text)) if text.startswith(said, k)]
        assert front.ends(np.array([low]), np.array([n]))[0] == sum(text[k - 1] == "a" for k in places)
        assert back.ends(np.array([back_low]), np.array([n]))[0] == sum(text[k + 4] == "a" for k in places)


def test_packing():
    for values in ([], [0], [1, 2**31 - 1, 0, 70_000]):
        values = np.array(values, np.int32)
        assert (fm_index.unpacked(fm_index.packed(values), len(values)) == values).all()
