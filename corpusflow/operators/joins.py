"""Equi-joins for change detection, index skipping, hydration and merge.

No broadcast hints on inputs of unknown size: AQE switches a join to
broadcast at runtime when the measured side is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``, i.e. only with a proven
size bound, and keeps the sort-merge/shuffled-hash join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_files(listing: DataFrame, state: DataFrame, key: str = "file_id", mtime: str = "modified_time") -> DataFrame:
    """Listing rows that are unknown or whose modified time differs (text inequality)."""
    s = state.select(F.col(key).alias("_k"), F.col(mtime).alias("_m"))
    cond = (listing[key] == s["_k"]) & listing[mtime].eqNullSafe(s["_m"])
    return listing.join(s, cond, "left_anti")


def prune_state(state: DataFrame, listing: DataFrame, key: str = "file_id") -> DataFrame:
    """State rows whose id is still listed."""
    return state.join(listing.select(key), key, "left_semi")


def advance_state(
    state: DataFrame, listing: DataFrame, fetched: DataFrame, key: str = "file_id", mtime: str = "modified_time"
) -> DataFrame:
    """Pruned state overlaid with the successfully fetched files (their new time wins)."""
    old = prune_state(state, listing, key).select(key, F.col(mtime).alias("_old"))
    new = fetched.select(key, F.col(mtime).alias("_new"))
    return old.join(new, key, "full_outer").select(key, F.coalesce("_new", "_old").alias(mtime))


def indexed_doc_ids(points: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Distinct non-blank document ids present in the index (only that column is read)."""
    return points.select(doc).where(F.col(doc).isNotNull() & (F.col(doc) != "")).distinct()


def skip_indexed(chunks: DataFrame, indexed: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Drop chunks whose *document* already has points."""
    return chunks.join(indexed.select(doc), doc, "left_anti")


def hydrate_chunks(refs: DataFrame, chunks: DataFrame, keys: tuple[str, ...] = ("doc_id", "chunk_id")) -> DataFrame:
    """Batch get by key list; missing refs are omitted, repeated refs collapse."""
    return refs.select(*keys).distinct().join(chunks, list(keys))


def get_chunk(chunks: DataFrame, doc_id: str, chunk_id: int) -> DataFrame:
    """Single lookup; both predicates reach the Parquet scan. Empty result = not found."""
    return chunks.where((F.col("doc_id") == F.lit(doc_id)) & (F.col("chunk_id") == F.lit(chunk_id))).select("text")


def attach_vectors(
    chunks: DataFrame, vectors: DataFrame, keys: tuple[str, ...] = ("doc_id", "chunk_id"), vector: str = "vector"
) -> DataFrame:
    """Vectors beside their chunks by key (never by position).

    A chunk without a vector or a vector without a chunk is an error, raised
    by the row itself while the join runs, with no extra counting pass.
    """
    v = vectors.select(*keys, F.col(vector).alias("_vec"), F.lit(True).alias("_has_v"))
    c = chunks.withColumn("_has_c", F.lit(True))
    j = c.join(v, list(keys), "full_outer")
    bad = F.col("_has_v").isNull() | F.col("_has_c").isNull()
    checked = F.when(bad, F.raise_error(F.lit("attach_vectors: chunks and vectors do not match"))).otherwise(F.col("_vec"))
    return j.withColumn(vector, checked).drop("_vec", "_has_v", "_has_c")


def upsert_join(old: DataFrame, batch: DataFrame, keys: tuple[str, ...] = ("doc_id", "chunk_id")) -> DataFrame:
    """Match half of an upsert: every key with its old and new side and the match kind."""
    o = old.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("old"))
    b = batch.select(*keys, F.struct(*[c for c in batch.columns if c not in keys]).alias("new"))
    j = o.join(b, list(keys), "full_outer")
    match = F.when(F.col("old").isNotNull() & F.col("new").isNotNull(), F.lit("update")).when(
        F.col("new").isNotNull(), F.lit("insert")
    ).otherwise(F.lit("keep"))
    return j.withColumn("action", match)

