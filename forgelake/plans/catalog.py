"""Registry of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.plans.views import Lake, expand


@dataclass(frozen=True)
class Query:
    name: str
    covers: str  # operators of the survey
    build: Callable[[Lake], DataFrame]
    check: str | None  # SQL for DuckDB, with view names


CATALOG: dict[str, Query] = {}


def query(covers: str, check: str | None = None):
    """Register a query under the function's name."""

    def add(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        if build.__name__ in CATALOG:
            raise ValueError(f"query registered twice: {build.__name__}")
        CATALOG[build.__name__] = Query(build.__name__, covers, build, check)
        return build

    return add


def runners() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(entry: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: entry.build(Lake(spark, folder))

    return {name: runner(entry) for name, entry in CATALOG.items()}


def checks() -> dict[str, str]:
    return {name: expand(entry.check) for name, entry in CATALOG.items() if entry.check}


def secs(column: str | Column) -> Column:
    """Whole seconds since the epoch: the same number in every engine and time zone."""
    c = F.col(column) if isinstance(column, str) else column
    return F.unix_seconds(c.cast("timestamp"))
