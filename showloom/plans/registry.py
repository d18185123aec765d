"""Named queries, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..sources.tables import Tables


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def add(build):
        QUERIES[build.__name__] = Query(build, sql)
        return build

    return add
