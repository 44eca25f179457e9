"""Shared helpers of the training-data operators: tables, stored intermediates, skew."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space that separates words in every contract: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of an Arrow batch that a task turns into Python objects together.
SLICE = 256
#: Rows of an inner side that may be broadcast; checked by a count, beyond it the join shuffles.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, and is compact (columnar, zstd)."""
    path = scratch_path(df.sparkSession, "llm", tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that a worker's memory follows the piece."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files of finished jobs now instead of
    at the driver's next full garbage collection, so peak disk stays low."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def broadcast_checked(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a stored table of a few fixed-width columns) with a broadcast hint
    if it has at most ``rows`` rows; otherwise unchanged, so the join shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


def salt(row_id: Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")


def with_group_min(df: DataFrame, key: str, value: str, out: str, salts: int = 64) -> DataFrame:
    """Add ``out`` = min(``value``) over rows of equal ``key``, hot keys split.

    Rows are dealt by (key, salt), so a key that holds a third of all rows spreads
    over ``salts`` tasks; the join partner has at most ``salts`` rows per key.
    """
    dealt = df.withColumn("_salt", salt(F.col(value), salts))
    parts = dealt.groupBy(key, "_salt").agg(F.min(value).alias("_part"))
    top = parts.groupBy(key).agg(F.min("_part").alias(out))
    per_salt = parts.select(key, "_salt").join(top, key)
    return dealt.join(per_salt, [key, "_salt"]).drop("_salt")
