"""Registered queries: every operator over the given tables, next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Collects ``name → (query, SQL)`` pairs; a query without SQL gets a rows-only check."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def register(self, sql: str | None = None):
        def add(query: Query) -> Query:
            self.queries[query.__name__] = query
            if sql is not None:
                self.sql[query.__name__] = sql
            return query

        return add


REGISTRY = Registry()
register = REGISTRY.register


def load_all() -> Registry:
    from logweir.registry import batches, catalogs, delivery, failures, history, jobs, projections, refresh, routes, sinks, streams, textual  # noqa: F401

    return REGISTRY
