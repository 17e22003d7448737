"""The registered queries and the SQL that each is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Queries that SQL does not express: tests hold them against plain forms.
WITHOUT_SQL: set[str] = set()


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL in another engine."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is None:
            WITHOUT_SQL.add(f.__name__)
        else:
            ORACLES[f.__name__] = sql
        return f

    return register
