"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import EXPORT_MAP
from ..functions.text import is_blank, is_supported, stem


def filter_supported(files: DataFrame, name: str = "name") -> DataFrame:
    """Keep files whose lower-cased suffix is in the allow-list."""
    return files.where(is_supported(F.col(name)))


def export_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EXPORT_MAP), "mime string, export_mime string, export_ext string")


def plan_export(listing: DataFrame, name: str = "name", mime: str = "mime") -> DataFrame:
    """Cloud-native types are exported (target = stem + extension); other files
    keep their name if the suffix is supported; the rest is dropped.

    The mapping has three rows, so it is broadcast.
    """
    m = F.broadcast(export_map(listing.sparkSession))
    j = listing.join(m, listing[mime] == m["mime"], "left").drop(m["mime"])
    exported = F.col("export_mime").isNotNull()
    target = F.when(exported, F.concat(stem(F.col(name)), F.col("export_ext"))).when(
        is_supported(F.col(name)), F.col(name)
    )
    return (
        j.withColumn("target_name", target)
        .withColumn("action", F.when(exported, F.lit("export")).otherwise(F.lit("download")))
        .where(F.col("target_name").isNotNull())
        .drop("export_ext")
    )


def drop_empty_text(docs: DataFrame, text: str = "text", blank: bool = False) -> DataFrame:
    """drive/git drop text that is exactly ''; web (``blank=True``) drops text blank after strip."""
    if blank:
        return docs.where(~is_blank(F.col(text)))
    return docs.where(F.col(text) != "")


def drop_blank_chunks(chunks: DataFrame, text: str = "text") -> DataFrame:
    """Remove chunks blank after strip."""
    return chunks.where(~is_blank(F.col(text)))


def build_documents(df: DataFrame, text: str = "text", source: str = "source", title: str = "title") -> DataFrame:
    """P5: the document shape ``text, source, title`` with a missing title as ''."""
    t = F.coalesce(F.col(title), F.lit("")) if title in df.columns else F.lit("")
    return df.select(F.col(text).alias("text"), F.col(source).alias("source"), t.alias("title"))


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text with ``+00:00`` and microseconds only when non-zero."""
    c = F.col(ts) if isinstance(ts, str) else ts
    micros = F.unix_micros(c) % 1_000_000
    utc = F.to_utc_timestamp(c, F.current_timezone())  # render the UTC wall clock whatever the session zone
    return F.when(micros == 0, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).otherwise(
        F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )


def reference_payload(chunks: DataFrame, created_at: Column) -> DataFrame:
    """Point payload without the chunk text, one ``created_at`` per batch."""
    return chunks.select(
        "*",
        F.struct(
            F.col("doc_id"), F.col("chunk_id"), F.col("source"), F.coalesce(F.col("title"), F.lit("")).alias("title"),
            iso_utc(created_at).alias("created_at"),
        ).alias("payload"),
    )


__all__ = [
    "filter_supported", "plan_export", "drop_empty_text", "drop_blank_chunks", "build_documents",
    "reference_payload", "iso_utc",
]
