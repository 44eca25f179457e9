"""A1-A5 aggregates, U1-U3 set operations, W2-W3 window-like operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import source_type


# -- A1 / A2 / U3: source types ------------------------------------------------------

def collect_source_types(docs: DataFrame, by: tuple[str, ...] = (), source: str = "source") -> DataFrame:
    """A1: sorted distinct source types per group (a bounded set: at most three values)."""
    st = source_type(F.col(source))
    agg = F.array_sort(F.collect_set(st)).alias("source_types")
    return docs.groupBy(*by).agg(agg) if by else docs.agg(agg)


def merge_source_types(old: Column, new: Column) -> Column:
    """Stored set union new set, distinct and sorted; no stored set -> the new one."""
    return F.array_sort(F.array_union(F.coalesce(old, new), new))


# -- A3 / A4 / A5: counts ---------------------------------------------------------------

def chunk_counts(chunks: DataFrame, doc: str = "doc_id") -> DataFrame:
    """A3: chunks per document (map-side partial counts, then one shuffle)."""
    return chunks.groupBy(doc).agg(F.count(F.lit(1)).alias("n_chunks"))


def skip_stats(all_chunks: DataFrame, indexed: DataFrame, doc: str = "doc_id") -> DataFrame:
    """A4: chunks and documents skipped because their document is already indexed.

    Chunks are counted per document first, so the join with the indexed id set sees
    one row per document, already dealt by its key, and no distinct count is left.
    Chunks without a document id count as chunks, not as a document.
    """
    flag = indexed.select(doc).distinct().withColumn("_idx", F.lit(True))
    per_doc = all_chunks.groupBy(doc).agg(F.count(F.lit(1)).alias("_chunks"))
    j = per_doc.join(flag, doc, "left")
    hit = F.coalesce(F.col("_idx"), F.lit(False))
    none = F.lit(0).cast("long")
    return j.agg(
        F.coalesce(F.sum("_chunks"), none).alias("all_chunks"),
        F.coalesce(F.sum(F.when(~hit, F.col("_chunks"))), none).alias("new_chunks"),
        F.coalesce(F.sum(F.when(hit, F.col("_chunks"))), none).alias("skipped_chunks"),
        F.count(doc).alias("all_docs"),
        F.count_if(hit).alias("skipped_docs"),
    )


def documents_per_source(docs: DataFrame, source: str = "source") -> DataFrame:
    """A5: documents per source type plus a total row (source_type NULL -> 'total')."""
    st = source_type(F.col(source)).alias("source_type")
    r = docs.select(st).rollup("source_type").agg(F.count(F.lit(1)).alias("documents"), F.grouping("source_type").alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.col("source_type")).alias("source_type"), "documents")


# -- U1 / U2: sets ---------------------------------------------------------------------------

def union_sources(*frames: DataFrame) -> DataFrame:
    """Bag union by column name, no dedup (drive, git, web order is irrelevant to a table)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def skipped_doc_ids(all_chunks: DataFrame, new_chunks: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Document ids in ``all`` but not in ``new``."""
    return all_chunks.select(doc).distinct().join(new_chunks.select(doc), doc, "left_anti")


# -- W2 / W3: position logic ------------------------------------------------------------------

def last_wins(batch: DataFrame, keys: tuple[str, ...], seq: str = "seq") -> DataFrame:
    """One row per key, the one with the highest ``seq``.

    ``max_by`` on a struct is a hash aggregate with map-side combine, so a key
    repeated many times is reduced before the shuffle (no per-key sort).
    """
    rest = [c for c in batch.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.col(seq)).alias("_b")
    return batch.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest])


def last_wins_window(batch: DataFrame, keys: tuple[str, ...], seq: str = "seq") -> DataFrame:
    """W2 as a window (row_number over the key, newest first)."""
    w = Window.partitionBy(*keys).orderBy(F.col(seq).desc())
    return batch.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def numbered(df: DataFrame, key: str, out: str = "position") -> DataFrame:
    """``df`` with the position (0, 1, ...) of each row in the order of ``key``, without a global window.

    Rows are dealt into key ranges and sorted there; the number of rows before a range is a
    running sum over one row per range. The dealt rows are stored once (checkpoint), so both
    uses see the same ranges. Rows of equal key share a range; their order is any.
    """
    from ..session import checkpoint_root

    checkpoint_root(df.sparkSession)
    id_ = F.monotonically_increasing_id()  # partition << 33 | place in it
    laid = df.repartitionByRange(F.col(key)).sortWithinPartitions(key).withColumn("_id", id_).checkpoint()
    part = F.shiftright("_id", 33)
    sizes = laid.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # one row per range
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    starts = sizes.select("_part", before.alias("_before"))
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return laid.withColumn("_part", part).join(starts, "_part").withColumn(out, place).drop("_id", "_part", "_before")


def micro_batches(df: DataFrame, size: int, key: str | None = None) -> DataFrame:
    """Consecutive groups of ``size`` rows in the order of ``key``, the same for every
    partitioning of ``df``: one row per group with its number, rows and the key of its first row."""
    col = key or df.columns[0]
    batch = F.floor(F.col("position") / size).cast("long")
    return numbered(df.select(col), col).groupBy(batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("rows"), F.min_by(F.col(col).cast("string"), "position").alias("first_key"))
