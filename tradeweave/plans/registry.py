"""The registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) by its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def register(name: str, f: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = f
    if sql:
        SQL[name] = sql
