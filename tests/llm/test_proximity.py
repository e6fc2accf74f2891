"""Proximity matches against a plain version that compares all pairs."""

from __future__ import annotations

import random
from collections import defaultdict

from wardflow.llm import decontaminate

ALIGNED = "item_id bigint, doc_id bigint, print bigint, begin int, offset int"


def plain(aligned):
    groups = defaultdict(set)
    for item, doc, mark, begin, offset in aligned:
        groups[item, doc, mark].add((begin, offset))
    return {
        key
        for key, held in groups.items()
        if any(0 < b - a <= decontaminate.SLACK and p != q for a, p in held for b, q in held)
    }


def test_all_alignments_are_compared(spark):
    draw = random.Random(4)
    # The near pair is 10/1 and 12/2; the alignment between them in order is of the same anchor.
    aligned = [(1, 1, 0, 10, 1), (1, 1, 0, 12, 1), (1, 1, 0, 12, 2), (None, 2, 0, 3, 1), (None, 2, 0, 7, 2)]
    aligned += [(2, 3, 0, 5, 1), (2, 3, 0, 5, 2), (2, 3, 0, 10, 1), (2, 3, 0, 10, 1)]
    for doc in range(10, 200):
        aligned += [(9, doc, 0, draw.randrange(30), draw.randrange(3)) for _ in range(draw.randrange(1, 6))]
    found = decontaminate.proximity_matches(spark.createDataFrame(aligned, ALIGNED))
    assert {tuple(r) for r in found.collect()} == plain(aligned)


def test_near_items_are_in_the_results(spark):
    item = "the quick brown fox jumps over one lazy dog today"
    rows = [
        (1, f"x {item} y"),
        (2, item.replace("over one lazy", "over one very lazy")),
        (3, item.replace("the quick", "the very quick")),
        (4, "nothing of it"),
        (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    items = decontaminate.read_items(benchmark, "item_id", "text")
    chosen = decontaminate.anchors(items, decontaminate.frequencies(docs, items, "text"))
    places = [(r.offset, r.word) for r in chosen.collect()]
    aligned = [
        (7, doc, 0, k - offset, offset)
        for doc, text in rows
        for k, word in enumerate((text or "").split())
        for offset, wanted in places
        if word == wanted
    ]
    near = {doc for _, doc, _ in plain(aligned)}
    found = {r.doc_id: r for r in decontaminate.find(docs, benchmark).collect()}
    assert near and {doc for doc, r in found.items() if r.near_items == ["7"]} == near
    assert {doc for doc, r in found.items() if r["items"] == ["7"]} == {1}
    report = {r.doc_id: r for r in decontaminate.report(docs, benchmark).collect()}
    assert {doc for doc, r in report.items() if r.n_near == 1} == near
