"""Queries with their SQL twins, registered by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalogue:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register the decorated query under its own name, with the SQL that gives the same rows."""

        def register(query: Query) -> Query:
            self.queries[query.__name__] = query
            if sql:
                self.oracles[query.__name__] = sql
            return query

        return register
