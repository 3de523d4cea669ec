"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and,
when the result is expressible in SQL, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    operator: str  # inventory id(s) of the operator exercised


QUERIES: dict[str, Query] = {}


def query(name: str, operator: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, oracle, operator)
        return fn
    return deco
