"""Registered queries: streaming jobs.

Each query starts its stream with ``availableNow`` over the driver folder
(only the documents table), waits for it, and returns the table it produced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import SnapshotTable
from ..sources.fixtures import Fixtures
from ..sources.scans import STATE_SCHEMA
from ..streaming import jobs as T
from .ingest import IngestJob
from .oracle_views import with_views
from .oracle_chunks import doc_chunks_sql, points_sql
from .registry import query

_DOCS = "SELECT text, source, title FROM v_docs"



def _docs_stream(fx: Fixtures):
    return T.table_stream(fx.spark, fx.sf_dir, "documents", T.DOCUMENT_SCHEMA)


def _as_docs(fx: Fixtures):
    return lambda batch: fx.v_docs(batch).select("text", "source", "title")


@query("stream_documents", "S7", with_views("SELECT n, source, text, title, lang FROM v_docs", "v_docs"))
def q_stream_documents(fx: Fixtures):
    root = T.stream_root(fx.spark, "documents")
    out = f"{root}/out"

    def each(batch, batch_id):
        fx.v_docs(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = T._start(_docs_stream(fx), each, root, {"availableNow": True})
    T.finish(q)
    return fx.spark.read.parquet(out).select("n", "source", "text", "title", "lang")


@query("ingest_stream", "T1", with_views(f"SELECT doc_id, chunk_id, text, source, title FROM ({doc_chunks_sql(_DOCS)})", "v_docs"))
def q_ingest_stream(fx: Fixtures):
    root = T.stream_root(fx.spark, "ingest")
    job = IngestJob(fx.spark, f"{root}/tables")
    q = T.start_ingest_stream(_docs_stream(fx), job, f"{root}/ckpt", {"availableNow": True}, _as_docs(fx))
    T.finish(q)
    return job.chunks().select("doc_id", "chunk_id", "text", "source", "title")


@query("ingest_now", "T2", with_views(
    f"SELECT collection, point_id, doc_id, chunk_id, source, title, vector FROM ({points_sql(_DOCS, None)})", "v_docs"))
def q_ingest_now(fx: Fixtures):
    root = T.stream_root(fx.spark, "now")
    job = IngestJob(fx.spark, f"{root}/tables")
    T.ingest_now(_docs_stream(fx), job, f"{root}/ckpt", _as_docs(fx))
    return job.points().select("collection", "point_id", "doc_id", "chunk_id", "source", "title", "vector")


@query("ingest_full", "T3", with_views(
    f"SELECT 'documents' AS collection, count(*) AS points, '0->1' AS versions FROM ({doc_chunks_sql(_DOCS)})", "v_docs"))
def q_ingest_full(fx: Fixtures):
    """Second, full pass over the same documents: chunks re-upserted, every vector skipped."""
    root = T.stream_root(fx.spark, "full")
    job = IngestJob(fx.spark, f"{root}/tables")
    T.ingest_now(_docs_stream(fx), job, f"{root}/ckpt", _as_docs(fx))
    before = job.registry_table.current_version()
    T.ingest_full(_docs_stream(fx), job, f"{root}/ckpt", _as_docs(fx))
    after = job.registry_table.current_version()
    return job.points().groupBy("collection").agg(F.count(F.lit(1)).alias("points")).withColumn(
        "versions", F.lit(f"{before}->{after}")
    )


@query("changed_files_stream", "T4", with_views("""
SELECT l.file_id, l.name, l.modified_time FROM v_listing l
WHERE NOT EXISTS (SELECT 1 FROM v_state s WHERE s.file_id = l.file_id AND s.modified_time IS NOT DISTINCT FROM l.modified_time)""",
    "v_listing", "v_state"))
def q_changed_files_stream(fx: Fixtures):
    root = T.stream_root(fx.spark, "changes")
    state = SnapshotTable(fx.spark, f"{root}/state", STATE_SCHEMA)
    state.write(fx.v_state(), 0)
    out = f"{root}/changed"
    q = T.start_change_detection(
        _docs_stream(fx), state, out, f"{root}/ckpt", {"availableNow": True}, lambda b: fx.v_listing(b)
    )
    T.finish(q)
    return fx.spark.read.parquet(out).select("file_id", "name", "modified_time")


def _told_apart(job: IngestJob) -> dict[str, DataFrame]:
    """Rows of the tables with a SHA-256 of what is long in them, so that two states are compared without moving texts."""
    digest = lambda c: F.unhex(F.sha2(c, 256)).alias("digest")
    payload = F.to_json(F.struct("text", "source", "title"))
    vector = F.to_json(F.struct("vector"))
    return {
        "chunks": job.chunks().select("doc_id", "chunk_id", "created_at", digest(payload)),
        "points": job.points().select("collection", "point_id", "doc_id", "chunk_id", digest(vector)),
    }


@query("idempotent_replay", "T5", with_views(f"""
WITH n AS (SELECT count(*) AS n FROM ({doc_chunks_sql(_DOCS)}))
SELECT 'chunks' AS "table", n AS rows_first, n AS rows_replayed, CAST(0 AS BIGINT) AS differing_rows FROM n
UNION ALL
SELECT 'points', n, n, CAST(0 AS BIGINT) FROM n""", "v_docs"))
def q_idempotent_replay(fx: Fixtures):
    """Ingest the corpus, replay the same batch, then ingest it again as a new batch:
    the tables must not change (one row per table with the row counts and the differing rows)."""
    root = T.stream_root(fx.spark, "replay")
    job = IngestJob(fx.spark, f"{root}/tables")
    docs = fx.v_docs().select("text", "source", "title")
    job.run(docs, 0)
    first = {name: rows.checkpoint() for name, rows in _told_apart(job).items()}
    job.run(docs, 0)  # replay of a committed batch: no-op
    job.run(docs, 1)  # same documents again: upserts change nothing, vectors skipped
    rows = []
    for name, b in _told_apart(job).items():
        a = first[name]
        both = a.withColumn("times", F.lit(1)).unionByName(b.withColumn("times", F.lit(-1)))
        diff = both.groupBy(*a.columns).agg(F.abs(F.sum("times")).alias("diff")).agg(F.coalesce(F.sum("diff"), F.lit(0))).first()[0]
        rows.append((name, a.count(), b.count(), diff))
    return fx.spark.createDataFrame(rows, "table string, rows_first long, rows_replayed long, differing_rows long")


@query("changed_files_stateful", "T4", with_views("""
SELECT l.file_id, l.name, l.modified_time FROM v_listing l
WHERE NOT EXISTS (SELECT 1 FROM v_state s WHERE s.file_id = l.file_id AND s.modified_time IS NOT DISTINCT FROM l.modified_time)""",
    "v_listing", "v_state"))
def q_changed_files_stateful(fx: Fixtures):
    """T4 with keyed streaming state (transformWithStateInPandas), seeded with the saved state."""
    from ..streaming.stateful import changed_files_stateful

    root = T.stream_root(fx.spark, "stateful")
    listing = fx.v_listing(_docs_stream(fx))
    out = changed_files_stateful(listing, fx.v_state())
    q = (
        out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt")
        .outputMode("append").trigger(availableNow=True).start()
    )
    T.finish(q)
    if q.exception():
        raise q.exception()
    return fx.spark.read.schema("file_id string, name string, modified_time string").parquet(f"{root}/out")


@query("state_snapshot", "S8", with_views("""
SELECT coalesce(l.file_id, s.file_id) AS file_id, CASE WHEN l.file_id IS NULL THEN s.modified_time ELSE l.modified_time END AS modified_time
FROM v_state s FULL OUTER JOIN v_listing l ON l.file_id = s.file_id""", "v_listing", "v_state"))
def q_state_snapshot(fx: Fixtures):
    """The poll state that a change-detecting stream left in its state store, read back as a table."""
    from ..streaming.stateful import changed_files_stateful, state_snapshot

    root = T.stream_root(fx.spark, "snapshot")
    out = changed_files_stateful(fx.v_listing(_docs_stream(fx)), fx.v_state())
    writer = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt")
    T.finish(q := writer.outputMode("append").trigger(availableNow=True).start())
    if q.exception():
        raise q.exception()
    return state_snapshot(fx.spark, f"{root}/ckpt")
