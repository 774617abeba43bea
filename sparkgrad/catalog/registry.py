"""Name -> query and name -> SQL, filled by the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def r6(*columns: str) -> list[str]:
    """Select-list items rounded to six places under their own names."""
    return [f"round({c}, 6) AS {c}" for c in columns]
