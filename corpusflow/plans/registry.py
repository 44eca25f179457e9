"""Registry of named queries: a Spark builder and, where SQL can express it, a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import Fixtures


@dataclass(frozen=True)
class Query:
    name: str
    op: str  # operator id from the inventory (S1, E6, ...)
    build: Callable[[Fixtures], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, op: str, sql: str | None = None):
    def deco(fn: Callable[[Fixtures], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, op, fn, sql)
        return fn

    return deco


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.build(Fixtures(spark, sf_dir))

    run.__name__ = q.name
    return run
