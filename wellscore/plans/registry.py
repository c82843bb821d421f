"""Query registry: name -> (Spark builder, optional DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    build: Builder
    sql: str | None
    ops: str  # inventory ids this query covers


REGISTRY: dict[str, Entry] = {}


def query(name: str, ops: str, sql: str | Callable[[], str] | None = None):
    def wrap(fn: Builder) -> Builder:
        text = sql() if callable(sql) else sql
        REGISTRY[name] = Entry(name, fn, text, ops)
        return fn

    return wrap
