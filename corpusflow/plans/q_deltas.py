"""Registered queries over delta runs: ingest by batches (K1-K3, T5), indexed lookups (J5, J6, S6), collections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import runs as R
from ..operators import store as K
from ..session import scratch_path
from ..sources.fixtures import Fixtures
from .deltas import DeltaIngest
from .oracle_chunks import doc_chunks_sql, points_sql
from .oracle_views import with_views
from .q_relational import _UPSERT_SQL
from .registry import query

_REVISED = ("SELECT CASE WHEN n % 10 = 5 THEN text || chr(10) || chr(10) || text ELSE substr(text, 1, length(text) // 2) END AS text, "
            "source, title || ' rev' AS title, n FROM v_docs WHERE n % 5 = 0")


def _numbered(docs_sql: str) -> str:
    """Chunks of a subset of the documents, each with the number of its document."""
    return f"SELECT c.*, d.n FROM ({doc_chunks_sql(docs_sql)}) c JOIN (SELECT source, n FROM v_docs) d USING (source)"


_DELTAS = f"""
WITH first_pass AS ({_numbered("SELECT text, source, title FROM v_docs")}),
second_pass AS ({_numbered(f"SELECT text, source, title FROM ({_REVISED})")}),
upserted AS (
  SELECT coalesce(b.doc_id, a.doc_id) AS doc_id, coalesce(b.chunk_id, a.chunk_id) AS chunk_id, coalesce(b.text, a.text) AS text,
    coalesce(b.source, a.source) AS source, coalesce(b.title, a.title) AS title, coalesce(a.n, b.n) AS n,
    CASE WHEN a.doc_id IS NULL THEN TIMESTAMP '2026-01-05 00:00:00' ELSE TIMESTAMP '2026-01-01 00:00:00' + to_days(CAST(a.n % 4 AS INTEGER)) END AS created_at
  FROM first_pass a FULL OUTER JOIN second_pass b ON a.doc_id = b.doc_id AND a.chunk_id = b.chunk_id)
SELECT doc_id, chunk_id, text, source, title, created_at FROM upserted WHERE n % 7 <> 3
UNION ALL
SELECT doc_id, chunk_id, text, source, title, TIMESTAMP '2026-01-07 00:00:00' FROM first_pass WHERE n % 21 = 3"""


def _day(k: int):
    return F.to_timestamp(F.lit(f"2026-01-0{k} 00:00:00"))


@query("ingest_job_deltas", "K1", with_views(_DELTAS, "v_docs"))
def q_ingest_job_deltas(fx: Fixtures):
    """Chunk table after five batches (the corpus in four parts, then a revision of every fifth
    document), a delete, a re-ingest of some deleted documents, and merges of runs in between."""
    job = DeltaIngest(fx.spark, scratch_path(fx.spark, "deltas"))
    docs = fx.v_docs().select("n", "text", "source", "title")
    for k in range(4):
        job.run(docs.where(F.col("n") % 4 == k).drop("n"), k, _day(k + 1))
    longer = F.concat(F.col("text"), F.lit("\n\n"), F.col("text"))
    half = F.expr("substring(text, 1, cast(floor(length(text) / 2) as int))")
    revised = docs.where("n % 5 = 0").withColumn("text", F.when(F.col("n") % 10 == 5, longer).otherwise(half))
    job.run(revised.select("text", "source", F.concat("title", F.lit(" rev")).alias("title")), 4, _day(5))
    from ..functions import ids

    job.delete_documents(docs.where("n % 7 = 3").select(ids.doc_id(F.col("source")).alias("doc_id")), 5)
    job.compact()
    job.run(docs.where("n % 21 = 3").drop("n"), 6, _day(7))
    job.run(docs.where("n % 21 = 3").drop("n"), 6, _day(9))  # a replayed batch changes nothing
    return job.chunks()


@query("lookup_chunks", "J5", f"""
WITH {with_views("SELECT 1", "v_points")[5:].rsplit("SELECT 1", 1)[0]},
u AS ({_UPSERT_SQL})
SELECT u.* FROM u JOIN (SELECT DISTINCT doc_id, chunk_id FROM v_points) r ON u.doc_id = r.doc_id AND u.chunk_id = r.chunk_id""")
def q_lookup_chunks(fx: Fixtures):
    """Chunks of all point references out of a stored table of two runs, through its index."""
    table = R.RunTable(R.RunLog(fx.spark, scratch_path(fx.spark, "lookup")), "chunks", K.CHUNK_SCHEMA, K.CHUNK_KEYS)
    state = table.log.load()
    R.append(table.log, state, {"chunks": table.write(fx.v_store())}, "store", 0)
    R.upsert_chunk_run(table, fx.v_batch(), F.to_timestamp(F.lit("2026-01-01 00:00:00")), 0)
    return table.lookup(fx.v_points().select("doc_id", "chunk_id"))


_ROUTED = """SELECT d.text, d.source, d.title, coalesce(r.collection, 'documents') AS collection
FROM v_docs d LEFT JOIN lang_routes r ON r.lang = d.lang"""


@query("ingest_job_multi_collection", "K7", with_views(f"""
WITH routed AS ({_ROUTED}), p AS (SELECT point_id, doc_id, chunk_id, source, title, vector FROM ({points_sql("SELECT DISTINCT text, source, title FROM routed", None)}))
SELECT r.collection, p.* FROM p JOIN routed r ON r.source = p.source""", "v_docs", "lang_routes"))
def q_ingest_job_multi_collection(fx: Fixtures):
    """Points of an ingest into several collections, routed by language; a document routed to
    several has its chunks stored once and points in each. The corpus comes twice; vectors stay."""
    job = DeltaIngest(fx.spark, scratch_path(fx.spark, "collections"))
    docs = K.route_collections(fx.v_docs(), fx.lang_routes(), default="documents").select("text", "source", "title", "collection")
    job.run(docs, 0, _day(1))
    job.run(docs, 1, _day(2))
    return job.points().select("collection", "point_id", "doc_id", "chunk_id", "source", "title", "vector")
