"""Where catalogue modules put their entries."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Entry(NamedTuple):
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a Spark query together with its SQL form."""
    def wrap(run: Query) -> Query:
        ENTRIES[name or run.__name__] = Entry(run, sql)
        return run
    return wrap
