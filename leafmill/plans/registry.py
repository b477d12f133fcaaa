"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str | Callable[[], str]] = {}


def query(name: str, sql: str | Callable[[], str] | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are counted, and a unit test checks it.

    SQL that takes work to build is given as a function, called when it is asked for.
    """

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def sql_texts() -> dict[str, str]:
    return {name: sql() if callable(sql) else sql for name, sql in SQL.items()}
