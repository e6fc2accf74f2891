"""All queries of the engine over the test tables, each with SQL that computes the same.

Query functions take ``(spark, sf_dir)``. The SQL next to them is what an independent database
must return for the same tables; it is only ever used for checking.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return run

    return register


def load() -> None:
    """Import the modules that register queries."""
    from wardflow.plans import (  # noqa: F401
        queries_changes,
        queries_documents,
        queries_jobs,
        queries_processed,
        queries_reports,
        queries_rows,
        queries_streams,
        queries_values,
    )
