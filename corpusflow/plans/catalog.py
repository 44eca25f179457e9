"""The registered query set (wired into ``__spark_entry__``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import q_deltas, q_relational, q_sources, q_stream, q_vectors  # noqa: F401  (importing registers the queries)
from .registry import REGISTRY, runner


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(q) for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.fixtures import Fixtures
    from .ingest import ingest_points

    return ingest_points(Fixtures(spark, sf_dir))
