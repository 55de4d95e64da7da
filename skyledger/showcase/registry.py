"""Where queries and their SQL are kept."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Shown:
    run: Query
    sql: str


QUERIES: dict[str, Shown] = {}


def shown(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name with the SQL of the same result."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = Shown(run, sql)
        return run

    return register
