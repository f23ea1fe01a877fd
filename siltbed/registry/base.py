"""Collection of named queries with their optional SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name; an oracle is added where the result can be written in SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, oracle: str | None = None) -> Callable[[Query], Query]:
        def keep(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"Query {name} is registered twice")
            self.queries[name] = fn
            if oracle is not None:
                self.oracles[name] = oracle
            return fn

        return keep
