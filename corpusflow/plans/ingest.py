"""The whole ingest, as one Spark job per batch.

documents -> doc_id (F1) -> chunks (F7, P4, W1) -> chunk table upsert (K1)
-> collection registry (A1, K4) -> skip indexed documents (S6, J4)
-> embed (D1) -> point ids and payload (F2, P6) -> point upsert (K3)
-> batch metrics (A3-A5).

``prepare_documents``, ``chunk_rows`` and ``embed_points`` are pure
DataFrame steps (``ingest_points`` composes them read-only). ``IngestJob``
adds storage: the batch's chunks are written once to the shared checkpoint
folder (so the Python chunker never re-runs when a later stage retries, and
lineage is cut), then the touched buckets of the point and chunk tables are
written as a new version, and one manifest commits both tables and the registry.
Until then readers see the state before, so re-running after a failure is safe.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ids
from ..functions.chunking import chunk_documents
from ..functions.constants import CHUNK_OVERLAP, CHUNK_SIZE, DEFAULT_COLLECTION, EMBED_BATCH
from ..functions.embedding import embed_col
from ..functions.text import source_type
from ..operators import aggregates as A
from ..operators import store as K
from ..operators.filters import iso_utc
from ..session import checkpoint_root

LOG_SCHEMA = (
    "batch_id int, ts timestamp, source_type string, collection string, n_docs long, n_chunks long, "
    "embed_requests long, embed_errors long, skipped long, duration_s double, ok boolean"
)

POINT_SCHEMA = T.StructType([
    T.StructField("collection", T.StringType(), False),
    T.StructField("point_id", T.DecimalType(20, 0), False),
    T.StructField("doc_id", T.StringType(), False),
    T.StructField("chunk_id", T.IntegerType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("created_at", T.StringType(), False),
    T.StructField("vector", T.ArrayType(T.FloatType()), False),
])


def prepare_documents(docs: DataFrame, collection: str | Column = DEFAULT_COLLECTION) -> DataFrame:
    """P5 + F1 + F3: ``doc_id, source, title, text, source_type, collection``."""
    coll = F.lit(collection) if isinstance(collection, str) else collection
    if "collection" in docs.columns and isinstance(collection, str) and collection == DEFAULT_COLLECTION:
        coll = F.coalesce(F.col("collection"), F.lit(DEFAULT_COLLECTION))
    seq = ["seq"] if "seq" in docs.columns else []
    return docs.select(
        *seq,
        ids.doc_id(F.col("source")).alias("doc_id"),
        F.col("source"),
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.col("text"),
        source_type(F.col("source")).alias("source_type"),
        coll.alias("collection"),
    )


def chunk_rows(docs: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Chunks of prepared documents: ``collection, doc_id, chunk_id, text, source, title, source_type``."""
    ch = chunk_documents(docs, "text", size, overlap, keep=("collection", "doc_id", "source", "title", "source_type"))
    return ch.select("collection", "doc_id", "chunk_id", F.col("chunk_text").alias("text"), "source", "title", "source_type")


def embed_points(chunks: DataFrame, now: Column, model: str = "hashing", dim: int = 64, batch: int = EMBED_BATCH) -> DataFrame:
    """D1 + F2 + P6: one point per chunk, the vector computed beside its keys (never zipped by position)."""
    return chunks.select(
        "collection",
        ids.point_id("doc_id", "chunk_id").alias("point_id"),
        "doc_id",
        "chunk_id",
        "source",
        "title",
        iso_utc(now).alias("created_at"),
        embed_col("text", model, dim, batch).alias("vector"),
    )


def ingest_points(fx, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Flagship read-only plan over the fixtures: documents of all three source
    families -> chunks -> embedded points (no tables written)."""
    from ..sources.scans import scan_pages

    from ..session import ensure_parallel

    docs = ensure_parallel(fx.v_docs().select("text", "source", "title"))
    web = scan_pages(fx.v_pages())
    prepared = prepare_documents(A.union_sources(docs, web))
    chunks = chunk_rows(prepared, size, overlap)
    return embed_points(chunks, F.to_timestamp(F.lit("2026-01-01 00:00:00")))


STATS_SCHEMA = "documents long, chunks long, embedded_chunks long, skipped_chunks long, batch_id int"


def _keyed_payload(chunks: DataFrame) -> DataFrame:
    """Chunk keys with two 64-bit hashes of the payload: what changed is found without shuffling texts."""
    return chunks.select(
        "doc_id", "chunk_id",
        F.xxhash64("text", "source", "title").alias("_h1"), F.xxhash64("title", "source", "text").alias("_h2"),
    )


class IngestJob:
    """Stateful D2 over keyed tables in a shared folder (the checkpoint root by default).

    Chunks and points are bucketed by ``doc_id``: a batch reads and rewrites
    only the buckets of its own documents (chunk upsert, index check, point
    upsert); the small collection registry is a versioned snapshot. One manifest
    commits all three. ``buckets`` is fixed with the first batch (64 by default).
    """

    def __init__(
        self, spark: SparkSession, root: str | None = None, skip_indexed: bool = True, model: str = "hashing",
        dim: int = 64, buckets: int | None = None, replace_docs: bool = False,
    ):
        self.spark = spark
        self.replace_docs = replace_docs  # Q6: a re-ingested document replaces all its old chunks
        self.root = (root or f"{checkpoint_root(spark)}/corpusflow/ingest").rstrip("/")
        self.skip_indexed = skip_indexed
        self.model = model
        self.dim = dim
        self.manifest = K.Manifest(spark, self.root)
        # the same key and bucket count for both tables: one list of touched buckets serves both
        self.chunk_table = K.KeyedTable(spark, self.root, K.CHUNK_SCHEMA, "doc_id", buckets, manifest=self.manifest, name="chunks")
        self.point_table = K.KeyedTable(
            spark, self.root, POINT_SCHEMA, "doc_id", buckets, ("collection",), manifest=self.manifest, name="points"
        )
        self.registry_table = K.SnapshotTable(spark, f"{self.root}/collections", K.REGISTRY_SCHEMA)

    def run(self, docs: DataFrame, batch_id: int, now: Column | None = None, stream: str = "batch") -> DataFrame:
        """Ingest one batch of documents (``text, source, title[, collection][, seq]``); returns batch stats.

        A batch of ``stream`` (whose numbers grow) is applied once. Documents with one
        source in one collection: the greatest ``seq`` wins (without it, or on a tie, a
        hash of the text decides). A batch that fails leaves a row with ``ok`` false in the log.
        """
        state = self.manifest.load()
        if K.Manifest.applied(state, stream, batch_id):  # replay of a committed batch is a no-op
            return self.spark.createDataFrame([], STATS_SCHEMA)
        if now is None:
            now = F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp")  # aware: no local-zone reading
        started = time.time()
        self._embedding = False
        try:
            return self._apply(docs, state, batch_id, now, stream, started)
        except Exception:
            self._log(f"failed-{uuid.uuid4().hex}", [
                (batch_id, dt.datetime.now(dt.timezone.utc), "", "", 0, 0, 0, int(self._embedding), 0, time.time() - started, False)
            ])
            raise

    def _apply(self, docs: DataFrame, state: dict, batch_id: int, now: Column, stream: str, started: float) -> DataFrame:
        version = state["version"] + 1
        staging = f"{self.root}/staging/v={version}"
        prepared = prepare_documents(docs).where(F.col("text") != "")
        # Two documents with one source share a doc_id (Q10). One aggregation over the sources
        # (no texts) gives the counts per collection and source type, and tells whether
        # documents collide; only then is the set reduced to the last one per id.
        facts = (
            prepared.groupBy("collection", "source_type", "source").count()
            .groupBy("collection", "source_type").agg(F.count(F.lit(1)).alias("documents"), F.max("count").alias("most")).collect()
        )
        if any(r["most"] > 1 for r in facts):
            order = F.struct(*[c for c in ("seq",) if c in prepared.columns], F.xxhash64("text"))
            prepared = A.last_wins(prepared.withColumn("_order", order), ("collection", "doc_id"), "_order").drop("_order")
        chunk_rows(prepared.drop("seq")).write.mode("overwrite").parquet(staging)
        chunks = self.spark.read.parquet(staging)  # unique (collection, doc_id, chunk_id)

        # the index check reads only the doc_id column of the batch's buckets
        touched = self.point_table.touched(chunks)  # same key and bucket count for chunks and points
        indexed = self.point_table.read(touched).select("collection", "doc_id").distinct()
        hit = F.coalesce(F.col("_idx"), F.lit(False))
        # batch counters per (collection, source type): a handful of rows
        per_type = chunks.join(indexed.withColumn("_idx", F.lit(True)), ["collection", "doc_id"], "left").groupBy(
            "collection", "source_type"
        ).agg(F.count(F.lit(1)).alias("chunks"), F.count_if(~hit).alias("fresh"), F.count_if(hit).alias("known")).collect()

        # texts are moved for the index check only where something is indexed
        skips = self.skip_indexed and self.point_table.holds(touched)
        todo = chunks.join(indexed, ["collection", "doc_id"], "left_anti") if skips else chunks
        pts = embed_points(todo, now, self.model, self.dim).select(*POINT_SCHEMA.fieldNames())
        # points: only the buckets of the chunks to embed (none on a replay)
        self._embedding = True
        buckets = self.point_table.touched(todo) if skips else touched
        points = self.point_table.stage(pts, lambda old, b: K.upsert_points(old, b, checked=True), version, buckets)
        self._embedding = False
        chunk_state = self._stage_chunks(chunks, touched, version, now, len({r["collection"] for r in facts}) > 1)

        types = A.collect_source_types(chunks.select("collection", "source"), ("collection",))
        reg = K.register_collections(
            self.registry_table.read(before=version), types.select(F.col("collection").alias("name"), "source_types"), now
        )
        self.registry_table.write(reg, version)
        documents = {(r["collection"], r["source_type"]): r["documents"] for r in facts}
        self._log_batch(version, batch_id, per_type, documents, time.time() - started)
        self.manifest.commit(state, {"points": points, "chunks": chunk_state}, stream, batch_id)  # everything above counts from here
        self.manifest.remove("staging")
        stats = [(
            sum(documents.values()), sum(r["chunks"] for r in per_type),
            sum(r["fresh"] for r in per_type), sum(r["known"] for r in per_type), batch_id,
        )]
        return self.spark.createDataFrame(stats, STATS_SCHEMA)

    def _stage_chunks(self, chunks: DataFrame, touched: list[int], version: int, now: Column, several: bool) -> dict:
        """Chunk table: only buckets holding a new or changed row are rewritten, so re-ingesting
        unchanged content (e.g. web pages fetched every poll) rewrites nothing."""
        if several:
            # the table has one row per (doc_id, chunk_id): a document in several collections counts once
            one = chunks.where("chunk_id = 0").groupBy("doc_id").agg(F.min("collection").alias("collection"))
            chunks = chunks.join(one, ["doc_id", "collection"], "left_semi")
        rows = chunks.select("doc_id", "chunk_id", "text", "source", "title")
        key = ["doc_id", "chunk_id"]
        old = self.chunk_table.read(touched)
        diff = _keyed_payload(rows).join(_keyed_payload(old), [*key, "_h1", "_h2"], "left_anti").select("doc_id")
        merge = lambda old, b: K.upsert_chunks(old, b, now, seq=None)
        if self.replace_docs:
            # stored chunks of the batch's documents that the batch no longer has are dropped too
            stale = old.select(*key).join(rows.select(*key), key, "left_anti").join(
                rows.select("doc_id").distinct(), "doc_id", "left_semi"
            )
            diff = diff.unionByName(stale.select("doc_id"))

            def merge(old, b):  # noqa: F811
                kept = old.join(b.select("doc_id").distinct(), "doc_id", "left_anti").unionByName(
                    old.join(b.select(*key), key, "left_semi")
                )
                return K.upsert_chunks(kept, b, now, seq=None)
        changed = self.chunk_table.touched(diff)
        return self.chunk_table.stage(rows.where(self.chunk_table.bucket_col().isin(changed)), merge, version, changed)

    def _log_batch(self, version: int, batch_id: int, per_type: list, documents: dict, seconds: float) -> None:
        """This batch's rows of the ingest log (the input of the metric operators A6-A10). Where
        nothing was new only the skipped chunks count: ``ok`` is NULL, as nothing was ingested."""
        ts = dt.datetime.now(dt.timezone.utc)
        self._log(f"{version}", [
            (batch_id, ts, r["source_type"], r["collection"], documents.get((r["collection"], r["source_type"]), 0) if n else 0,
             n, -(-n // EMBED_BATCH), 0, r["chunks"] - n, float(seconds) if n else 0.0, True if n else None)
            for r in per_type for n in [r["fresh"] if self.skip_indexed else r["chunks"]]
        ])

    def _log(self, name: str, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, LOG_SCHEMA).write.mode("overwrite").parquet(f"{self.root}/log/batch={name}")

    def ingest_log(self) -> DataFrame:
        if not self.manifest.names("log"):  # nothing ingested yet
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/log").drop("batch")

    def delete_documents(self, doc_ids: DataFrame, batch_id: int, stream: str = "batch") -> None:
        """K2: remove documents (``doc_id``) from the chunk and point tables as batch ``batch_id``."""
        state = self.manifest.load()
        if K.Manifest.applied(state, stream, batch_id):
            return
        version = state["version"] + 1
        checkpoint_root(self.spark)
        doc_ids = doc_ids.select("doc_id").distinct().checkpoint()  # the input may read the tables being changed
        staged = {t.name: t.stage(doc_ids, t.without, version) for t in (self.point_table, self.chunk_table)}
        self.registry_table.write(self.registry_table.read(before=version), version)
        self.manifest.commit(state, staged, stream, batch_id)

    def chunks(self) -> DataFrame:
        return self.chunk_table.read()

    def points(self) -> DataFrame:
        return self.point_table.read()

    def registry(self) -> DataFrame:
        return self.registry_table.read(before=self.manifest.load()["version"] + 1)
