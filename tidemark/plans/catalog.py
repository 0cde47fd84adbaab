"""All named queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Modules of this package that register queries, in the order of the documentation.
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its own name."""

    def put(f):
        QUERIES[f.__name__] = (f, sql)
        return f

    return put


def _load() -> None:
    from tidemark.plans import board, cases, fields, loading, made, more, pages, prices, reasons, states, stored, streams, work  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: f for name, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
