"""Counters, shares and score columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.functions.text import as_column


def wrapped(counter: Column | str, limit: int = 100) -> Column:
    """A running counter that starts again at 1 after ``limit``."""
    return F.pmod(as_column(counter) - 1, F.lit(limit)) + 1


def row_mean(columns: Sequence[Column | str]) -> Column:
    """Mean over columns of one row; null if any of them is."""
    return reduce(lambda a, b: a + b, [as_column(c) for c in columns]) / len(columns)
