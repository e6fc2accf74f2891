"""Repeated passages against a plain version that knows no chunks."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from wardflow.llm import catalog, line_chunks

SAID = re.compile(r"[^ \t\n\x0b\f\r]+")


def plain(rows):
    """``id: (text, lines removed)``: every run of lines against every place before. Ids once, not null."""
    first, whole, result = {}, {}, {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            result[doc_id] = (None, 0)
            continue
        lines = text.split("\n")
        said = [i for i, line in enumerate(lines) if SAID.search(line)]
        sizes = [len(SAID.findall(lines[i])) for i in said]
        gone = set()
        if sum(sizes) <= 50:
            key = tuple(lines[i] for i in said)
            if said and key in whole:
                gone = set(said)
            whole.setdefault(key, doc_id)
        for a in range(len(said)):
            for b in range(a, len(said)):
                if sum(sizes[a : b + 1]) > 50:
                    run = tuple(lines[i] for i in said[a : b + 1])
                    if first.setdefault(run, (doc_id, a)) != (doc_id, a):
                        gone |= set(said[a : b + 1])
        owner, removed = None, set()
        for i in range(len(lines)):
            owner = i if i in set(said) else owner
            removed |= {i} if owner in gone else set()
        left = "\n".join(line for i, line in enumerate(lines) if i not in removed)
        result[doc_id] = (left if SAID.search(left) or not removed else "", len(removed))
    return result


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return {r.doc_id: (r.text, r.n_removed_lines) for r in line_chunks.dedup_passages(docs).collect()}


@pytest.mark.parametrize("size", [2, 3, 5, 8, 12])
def test_planted_passages_of_short_lines_go_whole(spark, size):
    draw = random.Random(size)

    def line(words):
        return " ".join(f"w{draw.randrange(10**6)}" for _ in range(words))

    rows, passages = [], []
    for k in range(12):
        passage = [line(52 // size + 1) for _ in range(size)]
        passages.append(passage)
        for copy in range(3):
            spaced = [part for one in passage for part in ([one, ""] if copy == 1 else [one])]
            rows.append((k + 100 * copy, "\n".join([line(9), line(4), *spaced, line(7)])))
    got = found(spark, rows)
    assert got == plain(rows)
    for k, passage in enumerate(passages):
        assert all(one in got[k][0] for one in passage)
        assert not any(one in got[k + 100 * copy][0] for one in passage for copy in (1, 2))


def test_runs_of_few_lines_in_any_order(spark):
    """Lines from a small set, so that passages overlap, nest and follow themselves."""
    draw = random.Random(1)
    kinds = [" ".join(f"{c}{k}" for k in range(n)) for c, n in zip("abcdefgh", (3, 60, 11, 20, 17, 30, 1, 50))]
    kinds += ["", " \t", "x  y\u00a0z\u3000 q"]
    rows = [(k, "\n".join(draw.choice(kinds) for _ in range(draw.randrange(1, 14)))) for k in range(150)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one word"), (904, "one word"), (905, "\none word\n\n")]
    got = found(spark, rows)
    assert got == plain(rows)
    # Lines that came one by one in different texts are no copy.
    apart = [(1, "one\nx"), (2, "two\ny"), (3, "one\ntwo")]
    assert found(spark, apart)[3] == ("one\ntwo", 0)


def test_given_texts(spark, odd_rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    small = [tuple(r) for r in docs if (r.text or "").count("\n") < 200]
    assert found(spark, small) == plain(small)
    small = [r for r in odd_rows if (r[1] or "").count("\n") < 200]
    assert found(spark, small) == plain(small)


def test_repeated_rows_are_one_document(spark, repeated_dir, repeated_rows):
    got = catalog.queries()["op6_line_passages"](spark, repeated_dir)
    assert Counter(r.doc_id for r in got.collect()) == Counter(i for i, _ in repeated_rows)
