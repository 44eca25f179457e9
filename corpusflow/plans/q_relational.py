"""Registered queries: joins (J), aggregates (A), windows (W), sets (U), sorts (O),
scalar functions (F1-F6, F8, F11) and keyed tables (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as TX
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import store as K
from ..sources.fixtures import BATCH_TS, Fixtures
from . import oracle_sql as Q
from .oracle_views import doc_id_sql, point_id, source_type_sql, with_views
from .registry import query

BATCH_TS_SQL = "TIMESTAMP '2026-01-01 00:00:00'"


def _now():
    return F.to_timestamp(F.lit(BATCH_TS))


# -- J1-J3: poll state -------------------------------------------------------------------------

@query("changed_files", "J1", with_views("""
SELECT l.file_id, l.name, l.modified_time FROM v_listing l
WHERE NOT EXISTS (SELECT 1 FROM v_state s WHERE s.file_id = l.file_id AND s.modified_time IS NOT DISTINCT FROM l.modified_time)""",
    "v_listing", "v_state"))
def q_changed_files(fx: Fixtures):
    return J.changed_files(fx.v_listing(), fx.v_state()).select("file_id", "name", "modified_time")


@query("prune_state", "J2", with_views(
    "SELECT file_id, modified_time FROM v_state WHERE file_id IN (SELECT file_id FROM v_listing)", "v_listing", "v_state"))
def q_prune_state(fx: Fixtures):
    return J.prune_state(fx.v_state(), fx.v_listing())


def _fetched(fx: Fixtures):
    """Changed files that download: exportable or supported, minus simulated failures."""
    from ..operators.filters import plan_export

    ch = J.changed_files(fx.v_listing(), fx.v_state())
    planned = plan_export(ch)
    return planned.where(F.expr("CAST(substr(file_id, 2) AS BIGINT)") % 13 != 1).select("file_id", "modified_time")


_ADVANCE_SQL = with_views(f"""
WITH changed AS (
  SELECT l.* FROM v_listing l
  WHERE NOT EXISTS (SELECT 1 FROM v_state s WHERE s.file_id = l.file_id AND s.modified_time IS NOT DISTINCT FROM l.modified_time)),
fetched AS (
  SELECT file_id, modified_time FROM changed
  WHERE (mime IN ('application/vnd.google-apps.document', 'application/vnd.google-apps.spreadsheet',
                  'application/vnd.google-apps.presentation') OR {Q.kind('name')} IN {Q.SUPPORTED})
    AND CAST(substr(file_id, 2) AS BIGINT) % 13 <> 1),
pruned AS (SELECT * FROM v_state WHERE file_id IN (SELECT file_id FROM v_listing))
SELECT coalesce(f.file_id, p.file_id) AS file_id, coalesce(f.modified_time, p.modified_time) AS modified_time
FROM pruned p FULL OUTER JOIN fetched f ON p.file_id = f.file_id""", "v_listing", "v_state")


@query("advance_state", "J3", _ADVANCE_SQL)
def q_advance_state(fx: Fixtures):
    return J.advance_state(fx.v_state(), fx.v_listing(), _fetched(fx))


# -- J4-J8: chunks, points ----------------------------------------------------------------------------

_NEW_CHUNKS_SQL = "SELECT * FROM v_batch WHERE doc_id NOT IN (SELECT doc_id FROM v_points WHERE doc_id <> '')"


@query("skip_indexed", "J4", with_views(f"SELECT doc_id, chunk_id, seq, text FROM ({_NEW_CHUNKS_SQL})", "v_batch", "v_points"))
def q_skip_indexed(fx: Fixtures):
    return J.skip_indexed(fx.v_batch(), J.indexed_doc_ids(fx.v_points())).select("doc_id", "chunk_id", "seq", "text")


@query("hydrate_chunks", "J5", with_views("""
SELECT r.doc_id, r.chunk_id, s.text FROM (SELECT DISTINCT doc_id, chunk_id FROM v_points) r
JOIN v_store s ON s.doc_id = r.doc_id AND s.chunk_id = r.chunk_id""", "v_points", "v_store"))
def q_hydrate_chunks(fx: Fixtures):
    p = fx.v_points()
    refs = p.select("doc_id", "chunk_id").unionByName(p.select("doc_id", "chunk_id"))  # repeated refs collapse
    return J.hydrate_chunks(refs, fx.v_store()).select("doc_id", "chunk_id", "text")


@query("get_chunk", "J6", with_views("SELECT text FROM v_store WHERE doc_id = 'd2' AND chunk_id = 0", "v_store"))
def q_get_chunk(fx: Fixtures):
    return J.get_chunk(fx.v_store(), "d2", 0)


@query("attach_vectors", "J7", with_views(
    "SELECT doc_id, chunk_id, collection, vector FROM v_points WHERE doc_id <> ''", "v_points"))
def q_attach_vectors(fx: Fixtures):
    p = fx.v_points().where(F.col("doc_id") != "")
    chunks = p.select("doc_id", "chunk_id", "collection")
    vectors = p.select("doc_id", "chunk_id", "vector")
    return J.attach_vectors(chunks, vectors)


_DEDUP_SQL = """
SELECT doc_id, chunk_id, arg_max(text, seq) AS text, arg_max(source, seq) AS source, arg_max(title, seq) AS title,
       max(seq) AS seq
FROM v_batch GROUP BY doc_id, chunk_id"""


@query("upsert_join", "J8", with_views(f"""
SELECT coalesce(o.doc_id, b.doc_id) AS doc_id, coalesce(o.chunk_id, b.chunk_id) AS chunk_id,
  o.text AS old_text, b.text AS new_text,
  CASE WHEN o.doc_id IS NOT NULL AND b.doc_id IS NOT NULL THEN 'update' WHEN b.doc_id IS NOT NULL THEN 'insert' ELSE 'keep' END
    AS action
FROM v_store o FULL OUTER JOIN ({_DEDUP_SQL}) b ON o.doc_id = b.doc_id AND o.chunk_id = b.chunk_id""", "v_store", "v_batch"))
def q_upsert_join(fx: Fixtures):
    j = J.upsert_join(fx.v_store(), A.last_wins(fx.v_batch(), K.CHUNK_KEYS))
    return j.select("doc_id", "chunk_id", F.col("old.text").alias("old_text"), F.col("new.text").alias("new_text"), "action")


# -- W2 -----------------------------------------------------------------------------------------------

@query("last_wins", "W2", with_views(f"SELECT doc_id, chunk_id, text, seq FROM ({_DEDUP_SQL})", "v_batch"))
def q_last_wins(fx: Fixtures):
    return A.last_wins(fx.v_batch(), K.CHUNK_KEYS).select("doc_id", "chunk_id", "text", "seq")


@query("micro_batches", "W3", with_views("""
WITH p AS (SELECT point_id, row_number() OVER (ORDER BY point_id) - 1 AS pos FROM v_points)
SELECT CAST(pos // 100 AS BIGINT) AS batch, count(*) AS rows, arg_min(CAST(point_id AS VARCHAR), pos) AS first_key FROM p GROUP BY 1""", "v_points"))
def q_micro_batches(fx: Fixtures):
    from ..functions.constants import UPSERT_BATCH

    return A.micro_batches(fx.v_points().select("point_id"), UPSERT_BATCH, "point_id")


# -- A1-A5, U1-U3, O1-O2 ------------------------------------------------------------------------------------

def _routed(fx: Fixtures):
    return K.route_collections(fx.v_docs(), fx.lang_routes())


_ROUTED_SQL = "SELECT d.*, r.collection FROM v_docs d JOIN lang_routes r ON d.lang = r.lang"


@query("collect_source_types", "A1", with_views(f"""
SELECT collection, list_sort(list_distinct(list({source_type_sql('source')}))) AS source_types
FROM ({_ROUTED_SQL}) GROUP BY collection""", "v_docs", "lang_routes"))
def q_collect_source_types(fx: Fixtures):
    return A.collect_source_types(_routed(fx), ("collection",))


_BATCH_TYPES_SQL = f"""
SELECT collection AS name, list_sort(list_distinct(list({source_type_sql('source')}))) AS new_types
FROM ({_ROUTED_SQL}) GROUP BY collection"""


@query("merge_source_types", "A2", with_views(f"""
SELECT b.name, to_json(list_sort(list_distinct(list_concat(coalesce(r.source_types, b.new_types), b.new_types))))
  AS source_types_json
FROM ({_BATCH_TYPES_SQL}) b LEFT JOIN v_registry r ON r.name = b.name""", "v_docs", "lang_routes", "v_registry"))
def q_merge_source_types(fx: Fixtures):
    batch = A.collect_source_types(_routed(fx), ("collection",)).select(F.col("collection").alias("name"), F.col("source_types").alias("_new"))
    j = batch.join(fx.v_registry(), "name", "left")
    return j.select("name", F.to_json(A.merge_source_types(F.col("source_types"), F.col("_new"))).alias("source_types_json"))


@query("union_types", "U3", with_views(f"""
SELECT name, unnest(source_types) AS source_type FROM v_registry
UNION
SELECT name, unnest(new_types) FROM ({_BATCH_TYPES_SQL})""", "v_docs", "lang_routes", "v_registry"))
def q_union_types(fx: Fixtures):
    old = fx.v_registry().select("name", F.explode("source_types").alias("source_type"))
    new = A.collect_source_types(_routed(fx), ("collection",)).select(
        F.col("collection").alias("name"), F.explode("source_types").alias("source_type")
    )
    return old.union(new).distinct()


@query("sort_set", "O2", with_views(f"""
SELECT lang, list_sort(list_distinct(list({source_type_sql('source')}))) AS source_types FROM v_docs GROUP BY lang""", "v_docs"))
def q_sort_set(fx: Fixtures):
    return A.collect_source_types(fx.v_docs(), ("lang",))


# chunk tables for A4/U2 come from the line-split fixture; the real chunker is in q_vectors

@query("skip_stats", "A4", with_views("""
SELECT count(*) AS all_chunks,
  count(*) FILTER (WHERE i.doc_id IS NULL) AS new_chunks,
  count(*) FILTER (WHERE i.doc_id IS NOT NULL) AS skipped_chunks,
  count(DISTINCT b.doc_id) AS all_docs,
  count(DISTINCT CASE WHEN i.doc_id IS NOT NULL THEN b.doc_id END) AS skipped_docs
FROM v_batch b LEFT JOIN (SELECT DISTINCT doc_id FROM v_points WHERE doc_id <> '') i ON i.doc_id = b.doc_id""",
    "v_batch", "v_points"))
def q_skip_stats(fx: Fixtures):
    return A.skip_stats(fx.v_batch(), J.indexed_doc_ids(fx.v_points()))


@query("skipped_doc_ids", "U2", with_views(f"""
SELECT DISTINCT doc_id FROM v_batch EXCEPT SELECT doc_id FROM ({_NEW_CHUNKS_SQL})""", "v_batch", "v_points"))
def q_skipped_doc_ids(fx: Fixtures):
    b = fx.v_batch()
    new = J.skip_indexed(b, J.indexed_doc_ids(fx.v_points()))
    return A.skipped_doc_ids(b, new)


@query("documents_per_source", "A5", with_views(f"""
SELECT coalesce(st, 'total') AS source_type, count(*) AS documents
FROM (SELECT {source_type_sql('source')} AS st FROM v_docs) GROUP BY ROLLUP (st)""", "v_docs"))
def q_documents_per_source(fx: Fixtures):
    return A.documents_per_source(fx.v_docs())


@query("order_vectors", "O1", with_views(
    "SELECT doc_id, chunk_id, vector FROM v_points WHERE doc_id <> '' ORDER BY doc_id, chunk_id", "v_points"))
def q_order_vectors(fx: Fixtures):
    return fx.v_points().where(F.col("doc_id") != "").select("doc_id", "chunk_id", "vector").orderBy("doc_id", "chunk_id")


# -- A6-A10: metrics over the ingest log ---------------------------------------------------------------

def _label_text(labels: str = "labels"):
    entries = F.array_sort(F.map_entries(F.col(labels)))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def _samples_out(df):
    return df.select("metric", _label_text().alias("labels"), F.round("value", 6).alias("value"))


_COUNTERS_SQL = """
SELECT 'documents_ingested_total' AS metric, 'collection=' || collection || ',source_type=' || source_type AS labels,
       CAST(sum(n_docs) AS DOUBLE) AS value FROM v_ingest_log WHERE ok GROUP BY collection, source_type
UNION ALL
SELECT 'chunks_created_total', 'collection=' || collection, CAST(sum(n_chunks) AS DOUBLE) FROM v_ingest_log WHERE ok GROUP BY collection
UNION ALL SELECT 'embed_requests_total', '', CAST(sum(embed_requests) AS DOUBLE) FROM v_ingest_log
UNION ALL SELECT 'embed_errors_total', '', CAST(sum(embed_errors) AS DOUBLE) FROM v_ingest_log
UNION ALL SELECT 'documents_skipped_total', 'reason=already_indexed', CAST(sum(skipped) AS DOUBLE) FROM v_ingest_log"""


@query("counter_metrics", "A6", with_views(_COUNTERS_SQL, "v_ingest_log"))
def q_counter_metrics(fx: Fixtures):
    return _samples_out(M.counter_metrics(fx.v_ingest_log()))


_HIST_SQL = """
SELECT 'ingest_duration_seconds_bucket' AS metric, 'le=' || le || ',source_type=' || source_type AS labels, CAST(cnt AS DOUBLE) AS value
FROM (
  SELECT source_type, le, count(*) FILTER (WHERE duration_s <= b) AS cnt
  FROM v_ingest_log, (VALUES ('1.0', 1.0), ('5.0', 5.0), ('10.0', 10.0), ('30.0', 30.0), ('60.0', 60.0), ('120.0', 120.0),
                             ('300.0', 300.0), ('600.0', 600.0), ('+Inf', 'Infinity'::DOUBLE)) AS t(le, b)
  WHERE ok GROUP BY source_type, le)
UNION ALL
SELECT 'ingest_duration_seconds_sum', 'source_type=' || source_type, round(sum(duration_s), 6) FROM v_ingest_log WHERE ok GROUP BY source_type
UNION ALL
SELECT 'ingest_duration_seconds_count', 'source_type=' || source_type, CAST(count(*) AS DOUBLE) FROM v_ingest_log WHERE ok GROUP BY source_type"""


@query("duration_histogram", "A7", with_views(_HIST_SQL, "v_ingest_log"))
def q_duration_histogram(fx: Fixtures):
    return _samples_out(M.duration_histogram(fx.v_ingest_log()))


_LAST_SQL = """
SELECT 'last_ingest_timestamp_seconds' AS metric, 'collection=' || collection AS labels,
       round(epoch_us(max(ts)) / 1e6, 6) AS value
FROM v_ingest_log WHERE ok GROUP BY collection"""


@query("last_ingest", "A8", with_views(_LAST_SQL, "v_ingest_log"))
def q_last_ingest(fx: Fixtures):
    return _samples_out(M.last_ingest(fx.v_ingest_log()))


def _expo_sql() -> str:
    parts = f"({_COUNTERS_SQL}\nUNION ALL\n{_HIST_SQL}\nUNION ALL\n{_LAST_SQL})"
    lab = "CASE WHEN labels = '' THEN '' ELSE '{' || regexp_replace(labels, '=([^,]*)', '=\"\\1\"', 'g') || '}' END"
    num = ("CASE WHEN round(value, 6) = floor(round(value, 6)) THEN CAST(CAST(floor(round(value, 6)) AS BIGINT) AS VARCHAR) "
           "ELSE rtrim(printf('%.6f', round(value, 6)), '0') END")
    return with_views(f"SELECT metric || {lab} || ' ' || {num} AS line FROM {parts}", "v_ingest_log")


@query("metrics_exposition", "A9", _expo_sql())
def q_metrics_exposition(fx: Fixtures):
    return M.metrics_exposition(M.all_metrics(fx.v_ingest_log()))


# label values with a quote, a backslash and a line break
_ODD_LOG = """SELECT * REPLACE (CASE collection WHEN 'notes' THEN 'no"tes' || chr(92) || 'x' || chr(10) || 'y' ELSE collection END AS collection) FROM v_ingest_log"""
_HEADS = ", ".join(f"('{name}', {part}, '# {word} {name} {text}')" for name, kind, help_ in M.FAMILIES for part, word, text in ((0, "HELP", help_), (1, "TYPE", kind)))


def _text_sql() -> str:
    parts = f"({_COUNTERS_SQL}\nUNION ALL\n{_HIST_SQL}\nUNION ALL\n{_LAST_SQL})"
    odd = "replace(replace(replace(labels, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n')"
    lab = f"CASE WHEN labels = '' THEN '' ELSE '{{' || regexp_replace({odd}, '=([^,]*)', '=\"\\1\"', 'g') || '}}' END"
    num = ("CASE WHEN round(value, 6) = floor(round(value, 6)) THEN CAST(CAST(floor(round(value, 6)) AS BIGINT) AS VARCHAR) "
           "ELSE rtrim(printf('%.6f', round(value, 6)), '0') END")
    family = "regexp_replace(metric, '^(ingest_duration_seconds)_(bucket|sum|count)$', '\\1')"
    body = f"SELECT {family} AS family, 2 AS part, metric || {lab} || ' ' || {num} AS line FROM {parts} UNION ALL SELECT * FROM (VALUES {_HEADS}) AS t(family, part, line)"
    views = with_views("SELECT 1", "v_ingest_log")[5:].rsplit("SELECT 1", 1)[0]
    return f"WITH {views.replace('v_ingest_log AS', 'plain_log AS', 1)}, v_ingest_log AS ({_ODD_LOG.replace('FROM v_ingest_log', 'FROM plain_log')})\n{body}"


@query("metrics_text", "A9", _text_sql())
def q_metrics_text(fx: Fixtures):
    odd = F.when(F.col("collection") == "notes", F.lit('no"tes\\x\ny')).otherwise(F.col("collection"))
    return M.metrics_text(M.all_metrics(fx.v_ingest_log().withColumn("collection", odd)))


@query("embed_throughput", "A10", with_views("""
SELECT collection, sum(n_chunks) AS texts, round(sum(duration_s), 6) AS seconds,
  round(coalesce(sum(n_chunks) / nullif(sum(duration_s), 0), 0), 6) AS texts_per_s
FROM v_ingest_log GROUP BY collection""", "v_ingest_log"))
def q_embed_throughput(fx: Fixtures):
    return M.embed_throughput(fx.v_ingest_log())


# -- F1-F6, F8, F11 ---------------------------------------------------------------------------------------------

@query("doc_id", "F1", with_views(f"SELECT source, {doc_id_sql('source')} AS doc_id FROM v_docs", "v_docs"))
def q_doc_id(fx: Fixtures):
    return fx.v_docs().select("source", ids.doc_id("source").alias("doc_id"))


@query("point_id", "F2", with_views(f"SELECT doc_id, chunk_id, {point_id('doc_id', 'chunk_id')} AS point_id FROM v_store", "v_store"))
def q_point_id(fx: Fixtures):
    return fx.v_store().select("doc_id", "chunk_id", ids.point_id("doc_id", "chunk_id").alias("point_id"))


@query("source_type", "F3", with_views(f"SELECT source, {source_type_sql('source')} AS source_type FROM v_docs", "v_docs"))
def q_source_type(fx: Fixtures):
    return fx.v_docs().select("source", TX.source_type("source").alias("source_type"))


@query("source_uri", "F4", with_views("""
SELECT doc_id, 'gdrive://' || name AS drive_uri, 'https://git.example.org/' || repo || '.git' || '@' || path AS repo_uri
FROM v_files""", "v_files"))
def q_source_uri(fx: Fixtures):
    f = fx.v_files()
    url = F.concat(F.lit("https://git.example.org/"), F.col("repo"), F.lit(".git"))
    return f.select("doc_id", TX.drive_uri("name").alias("drive_uri"), TX.repo_uri(url, "path").alias("repo_uri"))


def _repo_urls(fx: Fixtures):
    d = fx.table("documents")
    m = F.col("doc_id") % 4
    base = F.concat(F.lit("https://git.example.org/team/"), F.col("source"))
    url = (
        F.when(m == 0, F.concat(base, F.lit(".git")))
        .when(m == 1, F.concat(base, F.lit(".git/")))
        .when(m == 2, F.concat(base, F.lit(".github.git//")))
        .otherwise(base)
    )
    return d.select("doc_id", url.alias("url"))


@query("repo_name", "F5", """
SELECT doc_id, url, replace(regexp_extract(regexp_replace(url, '/+$', ''), '([^/]*)$', 1), '.git', '') AS repo_name FROM (
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'https://git.example.org/team/' || source || '.git'
    WHEN 1 THEN 'https://git.example.org/team/' || source || '.git/'
    WHEN 2 THEN 'https://git.example.org/team/' || source || '.github.git//'
    ELSE 'https://git.example.org/team/' || source END AS url FROM documents)""")
def q_repo_name(fx: Fixtures):
    return _repo_urls(fx).select("doc_id", "url", TX.repo_name("url").alias("repo_name"))


def _odd_names(fx: Fixtures):
    f = fx.v_files()
    m = F.col("doc_id") % 5
    n = (
        F.when(m == 0, F.concat(F.lit("."), F.col("name")))
        .when(m == 1, F.concat(F.col("name"), F.lit(".")))
        .when(m == 2, F.concat(F.lit("a.tar"), F.regexp_extract("name", r"(\.[^.]+)$", 1)))
        .when(m == 3, F.regexp_replace("name", r"\.[^.]+$", ""))
        .otherwise(F.col("name"))
    )
    return f.select("doc_id", n.alias("name"))


@query("stem_suffix", "F6", with_views(f"""
SELECT doc_id, name, {Q.stem('name')} AS stem, {Q.suffix('name')} AS suffix FROM (
  SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '.' || name WHEN 1 THEN name || '.'
    WHEN 2 THEN 'a.tar' || regexp_extract(name, '(\\.[^.]+)$', 1)
    WHEN 3 THEN regexp_replace(name, '\\.[^.]+$', '') ELSE name END AS name FROM v_files)""", "v_files"))
def q_stem_suffix(fx: Fixtures):
    n = _odd_names(fx)
    return n.select("doc_id", "name", TX.stem("name").alias("stem"), TX.suffix("name").alias("suffix"))


def _legacy_store(fx: Fixtures):
    s = fx.v_store()
    n = F.expr("CAST(substr(doc_id, 2) AS BIGINT)")
    txt = (
        F.when(n % 5 == 0, F.lit("")).when(n % 5 == 1, F.lit(None).cast("string"))
        .otherwise(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    return s.select("doc_id", "chunk_id", "text", "source", txt.alias("created_at"))


_LEGACY_SQL = """
SELECT doc_id, chunk_id, text, source,
  CASE WHEN CAST(substr(doc_id, 2) AS BIGINT) % 5 = 0 THEN ''
       WHEN CAST(substr(doc_id, 2) AS BIGINT) % 5 = 1 THEN NULL
       ELSE strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') END AS created_at
FROM v_store"""


@query("migrate_created_at", "F8", with_views(f"""
SELECT doc_id, chunk_id, strptime(coalesce(nullif(created_at, ''), '1970-01-01T00:00:00Z'), '%Y-%m-%dT%H:%M:%SZ') AS created_at
FROM ({_LEGACY_SQL})""", "v_store"))
def q_migrate_created_at(fx: Fixtures):
    return _legacy_store(fx).select("doc_id", "chunk_id", TX.migrate_created_at("created_at").alias("created_at"))


@query("folder_id_from_url", "F11", """
SELECT doc_id, u, CASE WHEN contains(u, 'drive.google.com') AND regexp_extract(u, 'folders/([A-Za-z0-9_-]+)', 1) <> ''
  THEN regexp_extract(u, 'folders/([A-Za-z0-9_-]+)', 1) ELSE u END AS folder_id
FROM (SELECT doc_id, CASE doc_id % 3
    WHEN 0 THEN 'https://drive.google.com/drive/folders/' || substr(md5(source || CAST(doc_id AS VARCHAR)), 1, 20) || '?usp=sharing'
    WHEN 1 THEN substr(md5(source || CAST(doc_id AS VARCHAR)), 1, 20)
    ELSE 'https://drive.google.com/drive/u/0/my-drive' END AS u FROM documents)""")
def q_folder_id_from_url(fx: Fixtures):
    d = fx.table("documents")
    h = F.substring(F.md5(F.concat(F.col("source"), F.col("doc_id").cast("string"))), 1, 20)
    m = F.col("doc_id") % 3
    u = (
        F.when(m == 0, F.concat(F.lit("https://drive.google.com/drive/folders/"), h, F.lit("?usp=sharing")))
        .when(m == 1, h)
        .otherwise(F.lit("https://drive.google.com/drive/u/0/my-drive"))
    )
    return d.select("doc_id", u.alias("u")).select("doc_id", "u", TX.folder_id_from_url("u").alias("folder_id"))


# -- K1-K7 ----------------------------------------------------------------------------------------------------

_UPSERT_SQL = with_views(f"""
SELECT coalesce(o.doc_id, b.doc_id) AS doc_id, coalesce(o.chunk_id, b.chunk_id) AS chunk_id,
  CASE WHEN b.doc_id IS NOT NULL THEN b.text ELSE o.text END AS text,
  CASE WHEN b.doc_id IS NOT NULL THEN b.source ELSE o.source END AS source,
  CASE WHEN b.doc_id IS NOT NULL THEN coalesce(b.title, '') ELSE o.title END AS title,
  coalesce(o.created_at, {BATCH_TS_SQL}) AS created_at
FROM v_store o FULL OUTER JOIN ({_DEDUP_SQL}) b ON o.doc_id = b.doc_id AND o.chunk_id = b.chunk_id""", "v_store", "v_batch")


@query("upsert_chunks", "K1", _UPSERT_SQL)
def q_upsert_chunks(fx: Fixtures):
    return K.upsert_chunks(fx.v_store(), fx.v_batch(), _now())


@query("delete_doc", "K2", with_views("""
SELECT * FROM v_store WHERE doc_id NOT IN (SELECT 'd' || CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1)""", "v_store"))
def q_delete_doc(fx: Fixtures):
    toxic = fx.table("labels").where(F.col("toxic") == 1).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"))
    return K.delete_docs(fx.v_store(), toxic)


def _point_batch(fx: Fixtures):
    """New vectors for every third point and new points (chunk + 4) for every fifth."""
    from ..functions.vectors import l2_normalize

    p = fx.v_points()
    upd = p.where(F.col("vec_id") % 3 == 0).withColumn("vector", l2_normalize(F.reverse("vector")))
    new = p.where(F.col("vec_id") % 5 == 0).withColumn("chunk_id", F.col("chunk_id") + 4)
    new = new.withColumn("point_id", ids.point_id("doc_id", "chunk_id"))
    return upd.unionByName(new)


@query("upsert_points", "K3", with_views(f"""
WITH batch AS (
  SELECT collection, point_id, doc_id, chunk_id, vector FROM (
    SELECT vec_id, collection, doc_id, chunk_id,
      list_transform(list_reverse(vector), lambda x: CASE WHEN nrm = 0 THEN x ELSE CAST(CAST(x AS DOUBLE) / nrm AS FLOAT) END) AS vector,
      point_id
    FROM (SELECT *, sqrt(list_sum(list_transform(vector, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm FROM v_points)
    WHERE vec_id % 3 = 0)
  UNION ALL
  SELECT collection, {point_id('doc_id', 'chunk_id + 4')}, doc_id, chunk_id + 4, vector FROM v_points WHERE vec_id % 5 = 0)
SELECT coalesce(o.collection, b.collection) AS collection, coalesce(o.point_id, b.point_id) AS point_id,
  CASE WHEN b.point_id IS NOT NULL THEN b.doc_id ELSE o.doc_id END AS doc_id,
  CASE WHEN b.point_id IS NOT NULL THEN b.chunk_id ELSE o.chunk_id END AS chunk_id,
  CASE WHEN b.point_id IS NOT NULL THEN b.vector ELSE o.vector END AS vector
FROM (SELECT collection, point_id, doc_id, chunk_id, vector FROM v_points) o
FULL OUTER JOIN batch b ON o.collection = b.collection AND o.point_id = b.point_id""", "v_points"))
def q_upsert_points(fx: Fixtures):
    cols = ["collection", "point_id", "doc_id", "chunk_id", "vector"]
    return K.upsert_points(fx.v_points().select(*cols), _point_batch(fx).select(*cols))


@query("register_collection", "K4", with_views(f"""
SELECT coalesce(r.name, b.name) AS name,
  CASE WHEN b.name IS NOT NULL THEN list_sort(list_distinct(list_concat(coalesce(r.source_types, b.new_types), b.new_types)))
       ELSE r.source_types END AS source_types,
  CASE WHEN b.name IS NOT NULL THEN {BATCH_TS_SQL} ELSE r.updated_at END AS updated_at
FROM v_registry r FULL OUTER JOIN ({_BATCH_TYPES_SQL}) b ON r.name = b.name""", "v_docs", "lang_routes", "v_registry"))
def q_register_collection(fx: Fixtures):
    batch = A.collect_source_types(_routed(fx), ("collection",)).select(F.col("collection").alias("name"), "source_types")
    return K.register_collections(fx.v_registry(), batch, _now())


@query("ensure_tables", "K6", with_views(f"""
SELECT doc_id, chunk_id, text, coalesce(source, '') AS source, '' AS title,
  strptime(coalesce(nullif(created_at, ''), '1970-01-01T00:00:00Z'), '%Y-%m-%dT%H:%M:%SZ') AS created_at
FROM ({_LEGACY_SQL})""", "v_store"))
def q_ensure_tables(fx: Fixtures):
    return K.ensure_chunk_schema(_legacy_store(fx))


@query("route_collections", "K7", with_views(f"SELECT n, source, collection FROM ({_ROUTED_SQL})", "v_docs", "lang_routes"))
def q_route_collections(fx: Fixtures):
    return _routed(fx).select("n", "source", "collection")


@query("save_state", "K5", _ADVANCE_SQL)
def q_save_state(fx: Fixtures):
    from ..session import scratch_path
    from ..sources.scans import STATE_SCHEMA, load_state

    root = scratch_path(fx.spark, "state")
    K.SnapshotTable(fx.spark, root, STATE_SCHEMA).write(J.advance_state(fx.v_state(), fx.v_listing(), _fetched(fx)))
    return load_state(fx.spark, root)
