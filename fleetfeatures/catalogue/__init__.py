"""The registered queries, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Add a query under ``name``, with its SQL if SQL can express it."""
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add


def load() -> None:
    """Import the modules that register queries."""
    from fleetfeatures.catalogue import cleaning, merging, modelling, profiling, rows, tables  # noqa: F401
