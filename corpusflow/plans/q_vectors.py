"""Registered queries: chunking (F7, W1, A3), embedding (D1), vectors (F9, F10), whole ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.chunking import chunk_documents, chunk_list
from ..functions.constants import WS_CLASS
from ..functions.embedding import embed_frame
from ..functions.vectors import l2_normalize, quantize_int8
from ..operators import aggregates as A
from ..sources.fixtures import Fixtures
from .ingest import chunk_rows, ingest_points, prepare_documents
from .q_sources import _PAGES_SQL
from .oracle_chunks import doc_chunks_sql, embed_sql, points_sql
from .oracle_views import with_views
from .registry import query

_DOCS = "SELECT text, source, title FROM v_docs"


def _doc_chunks(fx: Fixtures):
    return chunk_rows(prepare_documents(fx.v_docs().select("text", "source", "title")))


# -- F7 / W1 / A3: the recursive splitter (Python UDF; rows-only check, brute-force tests) ------------

@query("chunk_text", "F7", with_views(f"""
SELECT d.source, coalesce(c.chunks, []) AS chunks FROM v_docs d LEFT JOIN (
  SELECT source, list(text ORDER BY chunk_id) AS chunks FROM ({doc_chunks_sql(_DOCS)}) GROUP BY source) c
ON c.source = d.source""", "v_docs"))
def q_chunk_text(fx: Fixtures):
    return fx.v_docs().select("source", chunk_list("text").alias("chunks"))


@query("number_chunks", "W1", with_views(f"SELECT doc_id, chunk_id, text FROM ({doc_chunks_sql(_DOCS)})", "v_docs"))
def q_number_chunks(fx: Fixtures):
    return _doc_chunks(fx).select("doc_id", "chunk_id", "text")


@query("chunk_counts", "A3", with_views(
    f"SELECT doc_id, count(*) AS n_chunks FROM ({doc_chunks_sql(_DOCS)}) GROUP BY doc_id", "v_docs"))
def q_chunk_counts(fx: Fixtures):
    return A.chunk_counts(_doc_chunks(fx))


# Character level of the splitter on whitespace-free text: windows of 1024 with step 896.
@query("chunk_windows", "F7", f"""
WITH t AS (SELECT doc_id, regexp_replace(text, '{WS_CLASS}', '', 'g') AS t FROM documents),
o AS (SELECT doc_id, t, CASE WHEN length(t) <= 1024 THEN [0] ELSE range(0, length(t) - 128, 896) END AS offs FROM t)
SELECT doc_id, CAST(generate_subscripts(offs, 1) - 1 AS INTEGER) AS chunk_id, substr(t, unnest(offs) + 1, 1024) AS text
FROM o WHERE length(t) > 0""")
def q_chunk_windows(fx: Fixtures):
    d = fx.table("documents").select("doc_id", F.regexp_replace("text", WS_CLASS, "").alias("text"))
    return chunk_documents(d, "text").select("doc_id", "chunk_id", F.col("chunk_text").alias("text"))


# -- D1: default hashing embedder over conversation turns ------------------------------------------

@query("embed", "D1", embed_sql("SELECT conv_id, turn, text FROM conversations", ("conv_id", "turn")))
def q_embed(fx: Fixtures):
    c = fx.table("conversations").select("conv_id", "turn", "text")
    return embed_frame(c).select("conv_id", "turn", "vector")


# -- F9 / F10 ---------------------------------------------------------------------------------------

@query("l2_normalize", "F9", """
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x * CAST(vec_id % 3 AS FLOAT) AS FLOAT)) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm FROM s)
SELECT vec_id, CASE WHEN nrm = 0 THEN v ELSE list_transform(v, lambda x: CAST(CAST(x AS DOUBLE) / nrm AS FLOAT)) END AS vector
FROM n""")
def q_l2_normalize(fx: Fixtures):
    e = fx.table("embeddings")
    k = (F.col("vec_id") % 3).cast("float")
    scaled = F.transform("embedding", lambda x: (x * k).cast("float"))
    return e.select("vec_id", l2_normalize(scaled).alias("vector"))


@query("quantize_int8", "F10", with_views("""
WITH x AS (SELECT collection, CAST(unnest(vector) AS DOUBLE) AS x FROM v_points),
r AS (SELECT collection, x, row_number() OVER (PARTITION BY collection ORDER BY x) AS rn,
             count(*) OVER (PARTITION BY collection) AS n FROM x),
b AS (SELECT collection,
        max(CASE WHEN rn = greatest(CAST(ceil(0.005 * n) AS BIGINT), 1) THEN x END) AS q_lo,
        max(CASE WHEN rn = greatest(CAST(ceil(0.995 * n) AS BIGINT), 1) THEN x END) AS q_hi
      FROM r GROUP BY collection)
SELECT p.vec_id, p.collection, b.q_lo, b.q_hi,
  list_transform(p.vector, lambda v: CAST(round(CASE WHEN b.q_hi - b.q_lo > 0
      THEN (least(greatest(CAST(v AS DOUBLE), b.q_lo), b.q_hi) - b.q_lo) / (b.q_hi - b.q_lo) * 255.0 ELSE 0.0 END) - 128 AS TINYINT))
    AS codes
FROM v_points p JOIN b ON b.collection = p.collection""", "v_points"))
def q_quantize_int8(fx: Fixtures):
    q = quantize_int8(fx.v_points().select("vec_id", "collection", "vector"))
    return q.select("vec_id", "collection", "q_lo", "q_hi", "codes")


# -- D2: documents of the three families -> embedded points ---------------------------------------------

@query("ingest", "D2", with_views(points_sql(
    f"SELECT text, source, title FROM v_docs UNION ALL SELECT text, source, title FROM ({_PAGES_SQL})"), "v_docs", "v_pages"))
def q_ingest(fx: Fixtures):
    return ingest_points(fx)
