"""Named queries and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if oracle is not None:
            ORACLES[run.__name__] = oracle
        return run

    return register
