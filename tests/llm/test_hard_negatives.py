"""Hard negatives against a plain version, on rows of every odd kind."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import hard_negatives
from wardflow.llm.strassen import product, strassen


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 19, 23), (64, 33, 50), (70, 64, 3), (0, 4, 5), (40, 100, 41)])
def test_strassen_is_exact(shape):
    draw = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = draw.integers(-(2**28), 2**28, (m, k)), draw.integers(-(2**28), 2**28, (k, n))
    assert (strassen(a, b, leaf=4) == a @ b).all()
    assert (product(a, b) == a @ b).all()


def test_products_beyond_64_bits_are_refused():
    big = np.full((1, 4), 2**40)
    assert product(big[:, :1], np.full((1, 1), 2**22)).item() == 2**62
    with pytest.raises(OverflowError):
        product(big, big.T)
    assert product(np.array([[2**62, 1]]), np.array([[1], [2**62 - 1]])).item() == 2**63 - 1


def plain(rows, positives=5, negatives=3):
    """``rows``: id, vector, label, anchor; ids that tie are told apart by nothing that is returned."""
    sound = [
        (i, [math.floor(256 * x) for x in v], label, anchor)
        for i, v, label, anchor in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = Counter()
    for a, (i, v, label, anchor) in enumerate(sound):
        if not anchor:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, k) for k, (j, w, _, _) in enumerate(sound) if k != a]
        scored.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0, s[2]))
        for score, j, _ in [s for s in scored if sound[s[2]][2] == label][:positives]:
            window = [s for s in scored if sound[s[2]][2] != label and 50 * score <= 100 * s[0] <= 95 * score]
            for rank, (other, n, _) in enumerate(window[:negatives], 1):
                found[(i, j, rank, n, score, other)] += 1
    return found


def odd_rows():
    draw = random.Random(11)
    rows = [(k, [draw.choice([0.0, 0.25, 0.5, 1.0, -0.3]) for _ in range(6)], k % 3, k % 5 == 0) for k in range(90)]
    rows += [
        (100, None, 1, True), (105, [1.0] * 6, None, True), (110, [1.0, None], 1, True), (115, [float("nan")] * 6, 1, True),
        (120, [float("inf")] + [0.0] * 5, 2, False), (125, [], 1, True), (130, [0.5, 0.5], 2, True), (135, [0.5] * 9, 0, True),
        (None, [0.5] * 6, 1, True), (None, [0.5] * 6, 2, False), (140, [0.0] * 6, 7, True), (145, [1.0] * 6, -4, None),
    ]
    return rows + rows[10:13] + [rows[0]] * 3


def as_table(spark, rows):
    full = [(i, v, label, anchor, "x", "y", 1) for i, v, label, anchor in rows]
    kinds = "`the id` bigint, vector array<double>, label int, `is it` boolean, row string, tile string, anchor_row int"
    return spark.createDataFrame(full, kinds).repartition(5)


def mined(table, **more):
    return hard_negatives.mine(table, F.col("is it"), "the id", "vector", "label", **more)


def test_odd_rows(spark, monkeypatch):
    rows = odd_rows()
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 4)
    monkeypatch.setattr(hard_negatives, "CANDIDATE_ROWS", 16)
    found = Counter(tuple(r) for r in mined(as_table(spark, rows)).collect())
    assert found == plain(rows)
    assert found


def test_one_tile_and_other_counts(spark):
    rows = odd_rows()
    found = Counter(tuple(r) for r in mined(as_table(spark, rows), positives=2, negatives=7).collect())
    assert found == plain(rows, 2, 7)


def test_nothing_to_mine(spark):
    rows = odd_rows()
    assert mined(as_table(spark, rows).filter("false")).collect() == []
    assert mined(as_table(spark, [r for r in rows if not r[3]])).collect() == []
    assert mined(as_table(spark, [r for r in rows if r[2] == 1])).collect() == []


def test_too_large_components(spark):
    rows = [(1, [1e30], 1, True), (2, [1e30], 2, False)]
    with pytest.raises(Exception, match="does not fit"):
        mined(as_table(spark, rows)).collect()
