"""Registered queries: scans (S), extraction (E), filters and projections (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.html import html_text, html_title
from ..functions.text import is_blank
from ..functions.titles import first_line_title, rst_title
from ..operators import extract as X
from ..operators import filters as P
from ..sources import scans as S
from ..session import ensure_parallel
from ..sources.fixtures import BATCH_TS, Fixtures
from . import oracle_sql as Q
from .oracle_views import NL, py_strip, with_views
from .registry import query

# -- S1 ---------------------------------------------------------------------------------------

@query("list_files", "S1", with_views(
    "SELECT file_id, name, mime, modified_time FROM v_listing WHERE parent = 'root' AND NOT trashed", "v_listing"))
def q_list_files(fx: Fixtures):
    return S.list_files(fx.v_listing(), "root")


# -- S2: repo specs derived from the corpus' source column ------------------------------------

def _repo_specs(fx: Fixtures):
    d = fx.table("documents").select("source").distinct()
    k = F.expr("CAST(substr(source, 4) AS INT)") % 3
    glob = F.when(k == 0, F.lit("**/*")).when(k == 1, F.lit("en/*")).otherwise(F.lit("**/*.md"))
    return d.select(
        F.col("source").alias("repo"), F.concat(F.lit("https://git.example.org/"), F.col("source"), F.lit(".git")).alias("url"),
        glob.alias("glob"),
    )


_SPECS_SQL = """
SELECT DISTINCT source AS repo, 'https://git.example.org/' || source || '.git' AS url,
  CASE CAST(substr(source, 4) AS INTEGER) % 3 WHEN 0 THEN '^(?:[^/]*/)*[^/]*$' WHEN 1 THEN '^en/[^/]*$'
    ELSE '^(?:[^/]*/)*[^/]*\\.md$' END AS re
FROM documents"""


@query("scan_tree", "S2", with_views(f"""
SELECT s.url, f.path, s.url || '@' || f.path AS source_uri
FROM v_files f JOIN ({_SPECS_SQL}) s ON f.repo = s.repo
WHERE regexp_full_match(f.path, s.re) AND {Q.kind('f.name')} IN {Q.SUPPORTED}""", "v_files"))
def q_scan_tree(fx: Fixtures):
    m = S.match_tree(fx.v_files(), _repo_specs(fx))
    return m.select("url", "path", F.concat(F.col("url"), F.lit("@"), F.col("path")).alias("source_uri"))


def _write_tree(fx: Fixtures) -> str:
    """The files of ``v_files`` as a real tree, ``<repo>/<path>``, in the shared folder: the input of the two queries below."""
    from ..session import scratch_path

    root = scratch_path(fx.spark, "tree")

    def write(rows):
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(root)
        for r in rows:
            path = f"{top}/{r.repo}/{r.path}"
            store.create_dir(path.rpartition("/")[0])
            with store.open_output_stream(path) as out:
                out.write(r.content.encode())

    fx.v_files().select("repo", "path", "content").foreachPartition(write)
    return root


def _repo_globs(fx: Fixtures) -> str:
    """Repository -> glob as JSON: one entry per configured repository."""
    import json

    return json.dumps({r.repo: r.glob for r in _repo_specs(fx).collect()})


_TREE_SQL = with_views(f"""
SELECT f.repo || '/' || f.path AS path, CAST(octet_length(encode(f.content)) AS BIGINT) AS length,
  regexp_replace(f.content, '\r\n?', chr(10), 'g') AS text
FROM v_files f JOIN ({_SPECS_SQL}) s ON f.repo = s.repo
WHERE regexp_full_match(f.path, s.re) AND {Q.kind('f.name')} IN {Q.SUPPORTED}""", "v_files")


@query("scan_tree_storage", "S2", _TREE_SQL)
def q_scan_tree_storage(fx: Fixtures):
    """S2 on storage: files of a tree of repositories, each by its own glob; others are never opened."""
    from ..sources.trees import register_tree_source

    register_tree_source(fx.spark)
    files = fx.spark.read.format("corpus_tree").option("globs", _repo_globs(fx)).load(_write_tree(fx))
    return S.read_text(files).select("path", "length", "text")


@query("stream_tree", "S7", _TREE_SQL)
def q_stream_tree(fx: Fixtures):
    """The same tree as a stream with offsets of its own, run until nothing new is found."""
    from ..session import scratch_path
    from ..sources.trees import register_tree_source

    register_tree_source(fx.spark)
    root, out = _write_tree(fx), scratch_path(fx.spark, "stream-tree")
    files = fx.spark.readStream.format("corpus_tree").option("globs", _repo_globs(fx)).load(root)
    writer = S.read_text(files).select("path", "length", "text").writeStream.format("parquet").option("path", f"{out}/files")
    stream = writer.option("checkpointLocation", f"{out}/offsets").trigger(processingTime="0 seconds").start()
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    return fx.spark.read.schema("path string, length long, text string").parquet(f"{out}/files")


# -- S3: bytes with bad UTF-8 and CR/CRLF line ends ----------------------------------------------

@query("read_text", "S3", f"""
SELECT doc_id,
  CASE doc_id % 10 WHEN 3 THEN text || chr(65533) WHEN 9 THEN text || chr(65533) || ' end' ELSE text END AS text
FROM documents""")
def q_read_text(fx: Fixtures):
    d = fx.table("documents")
    m = F.col("doc_id") % 10
    raw = (
        F.when(m == 3, F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF"))))
        .when(m == 5, F.encode(F.replace(F.col("text"), F.lit("\n"), F.lit("\r")), "UTF-8"))
        .when(m == 7, F.encode(F.replace(F.col("text"), F.lit("\n"), F.lit("\r\n")), "UTF-8"))
        .when(m == 9, F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("E282")), F.encode(F.lit(" end"), "UTF-8")))
        .otherwise(F.encode("text", "UTF-8"))
    )
    return S.read_text(d.select("doc_id", raw.alias("content"))).select("doc_id", "text")


# -- S4 -------------------------------------------------------------------------------------------

_PAGES_SQL = f"""
SELECT text, source, title FROM (
  SELECT CASE WHEN contains(lower(content_type), 'html') THEN {Q.html_text('body', f'{NL} || {NL}')} ELSE body END AS text,
         url AS source,
         CASE WHEN contains(lower(content_type), 'html') THEN {Q.html_title('body')} ELSE '' END AS title
  FROM v_pages) WHERE NOT {Q.is_blank('text')}"""


@query("scan_pages", "S4", with_views(_PAGES_SQL, "v_pages"))
def q_scan_pages(fx: Fixtures):
    return S.scan_pages(fx.v_pages())


# -- S5 --------------------------------------------------------------------------------------------

def _config(fx: Fixtures):
    d = fx.table("documents")
    good = F.concat(
        F.lit('[{"url":"https://git.example.org/'), F.col("source"), F.lit('.git","glob":"'), F.col("lang"),
        F.lit('/**"},{"glob":"*.md"},{"url":"https://mirror.example.org/'), F.col("doc_id").cast("string"), F.lit('.git"}]'),
    )
    cfg = F.when(F.col("doc_id") % 17 == 0, F.lit('[{"url": "broken')).otherwise(good)
    return d.select("doc_id", cfg.alias("config"))


_CONFIG_SQL = """
SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN '[{"url": "broken'
  ELSE '[{"url":"https://git.example.org/' || source || '.git","glob":"' || lang || '/**"},{"glob":"*.md"},'
       || '{"url":"https://mirror.example.org/' || CAST(doc_id AS VARCHAR) || '.git"}]' END AS config
FROM documents"""


@query("parse_source_config", "S5", f"""
WITH c AS ({_CONFIG_SQL}),
p AS (SELECT doc_id, from_json(config, '[{{"url":"VARCHAR","glob":"VARCHAR"}}]') AS arr FROM c WHERE json_valid(config)),
e AS (SELECT doc_id, unnest(arr) AS s, generate_subscripts(arr, 1) - 1 AS pos FROM p)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, s.url AS url, coalesce(s.glob, '**/*') AS glob
FROM e WHERE s.url IS NOT NULL AND s.url <> ''""")
def q_parse_source_config(fx: Fixtures):
    return S.parse_repo_specs(_config(fx)).select("doc_id", F.col("pos").cast("int").alias("pos"), "url", "glob")


# -- S6 ----------------------------------------------------------------------------------------------

@query("scan_indexed_docs", "S6", with_views("SELECT DISTINCT doc_id FROM v_points WHERE doc_id <> ''", "v_points"))
def q_scan_indexed_docs(fx: Fixtures):
    return S.scan_indexed_docs(fx.v_points())


# -- S8 ----------------------------------------------------------------------------------------------

@query("load_state", "S8", with_views("SELECT file_id, modified_time FROM v_state", "v_state"))
def q_load_state(fx: Fixtures):
    from ..operators.store import SnapshotTable
    from ..session import scratch_path

    root = scratch_path(fx.spark, "state")
    SnapshotTable(fx.spark, root, S.STATE_SCHEMA).write(fx.v_state())
    return S.load_state(fx.spark, root)


# -- E1 / E10 ---------------------------------------------------------------------------------------

def _extract_sql(files: str = "v_files", stated: str = "''") -> str:
    """``stated``: the metadata title of office files, an expression over the rows of ``files``."""
    k, st = Q.kind("name"), Q.stem("name")
    direct = f"""
SELECT name, {k} AS kind,
  CASE WHEN {k} IN ('.md', '.txt', '.adoc', '.rst') THEN content
       WHEN {k} IN ('.html', '.htm') THEN {Q.html_text('content', NL)} ELSE '' END AS text,
  CASE WHEN {k} IN ('.md', '.adoc') THEN {Q.or_stem(Q.first_line_title('content'), st)}
       WHEN {k} = '.rst' THEN {Q.or_stem(Q.rst_title('content'), st)}
       WHEN {k} = '.txt' THEN {Q.or_stem("''", st)}
       WHEN {k} IN ('.html', '.htm') THEN {Q.or_stem(Q.html_title('content'), st)} ELSE '' END AS title
FROM {files} WHERE {k} NOT IN ('.pdf', '.docx', '.pptx', '.xlsx')"""
    parts = f"""
SELECT name, {k} AS kind, unnest(string_split(content, {NL})) AS t,
       generate_subscripts(string_split(content, {NL}), 1) AS o, {py_strip(stated)} AS stated
FROM {files} WHERE {k} IN ('.pdf', '.docx', '.pptx', '.xlsx')"""
    office = f"""
SELECT name, kind, coalesce(CASE
    WHEN kind = '.pdf' THEN string_agg(coalesce(t, ''), {NL} || {NL} ORDER BY o)
    WHEN kind = '.docx' THEN string_agg(CASE WHEN NOT {Q.is_blank('t')} THEN t END, {NL} || {NL} ORDER BY o)
    WHEN kind = '.pptx' THEN string_agg(coalesce(t, ''), {NL} || {NL} ORDER BY o) END, '') AS text,
  {Q.or_stem("any_value(stated)", Q.stem('name'))} AS title
FROM parts WHERE kind <> '.xlsx' GROUP BY name, kind"""
    xlsx = f"""
SELECT name, '.xlsx' AS kind, coalesce(string_agg(r, {NL} ORDER BY o), '') AS text, {Q.or_stem("''", Q.stem('name'))} AS title
FROM (SELECT name, o, string_agg(v, ' | ' ORDER BY c) AS r FROM (
        SELECT name, o, unnest(string_split(t, ', ')) AS v, generate_subscripts(string_split(t, ', '), 1) AS c
        FROM parts WHERE kind = '.xlsx') GROUP BY name, o)
GROUP BY name"""
    return with_views(
        f"WITH parts AS ({parts})\n{direct}\nUNION ALL\n{office}\nUNION ALL\n{xlsx}", "v_files"
    )


@query("extract_documents", "E1", _extract_sql())
def q_extract_documents(fx: Fixtures):
    return X.extract_documents(fx.v_files())


# metadata titles: stated, blank and missing ones
_STATED = "CASE doc_id % 5 WHEN 0 THEN ' Report ' || source || ' ' WHEN 1 THEN '  ' WHEN 2 THEN lang END"


@query("resolve_title", "E10", f"SELECT name, title FROM ({_extract_sql('(SELECT * FROM v_files JOIN (SELECT doc_id, lang, source FROM documents) USING (doc_id))', _STATED)})")
def q_resolve_title(fx: Fixtures):
    stated = fx.table("documents").select("doc_id", F.expr(_STATED).alias("stated"))
    return X.extract_documents(fx.v_files().join(stated, "doc_id"), title="stated").select("name", "title")


# -- E2-E5 ---------------------------------------------------------------------------------------------

@query("assemble_pages", "E2", with_views(
    f"SELECT doc, string_agg(coalesce(text, ''), {NL} || {NL} ORDER BY ord) AS text FROM v_pages_parts GROUP BY doc",
    "v_pages_parts"))
def q_assemble_pages(fx: Fixtures):
    return X.assemble_pages(fx.v_pages_parts())


@query("assemble_paragraphs", "E3", with_views(
    f"SELECT doc, coalesce(string_agg(CASE WHEN NOT {Q.is_blank('text')} THEN text END, {NL} || {NL} ORDER BY ord), '') AS text "
    "FROM v_pages_parts GROUP BY doc", "v_pages_parts"))
def q_assemble_paragraphs(fx: Fixtures):
    return X.assemble_paragraphs(fx.v_pages_parts())


@query("assemble_shapes", "E4", with_views(
    f"SELECT doc, coalesce(string_agg(CASE WHEN has_text THEN coalesce(text, '') END, {NL} || {NL} ORDER BY ord), '') AS text "
    "FROM v_pages_parts GROUP BY doc", "v_pages_parts"))
def q_assemble_shapes(fx: Fixtures):
    return X.assemble_shapes(fx.v_pages_parts())


@query("assemble_cells", "E5", with_views(f"""
SELECT doc, coalesce(string_agg(r, {NL} ORDER BY sheet, "row"), '') AS text FROM (
  SELECT doc, sheet, "row", string_agg(value, ' | ' ORDER BY col) AS r
  FROM v_cells GROUP BY doc, sheet, "row")
GROUP BY doc""", "v_cells"))
def q_assemble_cells(fx: Fixtures):
    return X.assemble_cells(fx.v_cells())


# -- E6-E9 ----------------------------------------------------------------------------------------------

@query("html_text", "E6", f"SELECT page_id, {Q.html_text('html', NL)} AS text FROM pages")
def q_html_text(fx: Fixtures):
    return ensure_parallel(fx.table("pages")).select("page_id", html_text(F.col("html"), "\n").alias("text"))


@query("html_title", "E7", f"SELECT page_id, {Q.html_title('html')} AS title FROM pages")
def q_html_title(fx: Fixtures):
    return ensure_parallel(fx.table("pages")).select("page_id", html_title(F.col("html")).alias("title"))


@query("first_line_title", "E8", with_views(f"SELECT doc_id, {Q.first_line_title('content')} AS title FROM v_files", "v_files"))
def q_first_line_title(fx: Fixtures):
    return fx.v_files().select("doc_id", first_line_title(F.col("content")).alias("title"))


@query("rst_title", "E9", with_views(f"SELECT doc_id, {Q.rst_title('content')} AS title FROM v_files", "v_files"))
def q_rst_title(fx: Fixtures):
    return fx.v_files().select("doc_id", rst_title(F.col("content")).alias("title"))


# -- P1-P6 ---------------------------------------------------------------------------------------------

@query("filter_supported", "P1", with_views(f"SELECT doc_id, name FROM v_files WHERE {Q.kind('name')} IN {Q.SUPPORTED}", "v_files"))
def q_filter_supported(fx: Fixtures):
    return P.filter_supported(fx.v_files()).select("doc_id", "name")


@query("plan_export", "P2", with_views(f"""
SELECT file_id, name, mime, export_mime, target_name, action FROM (
  SELECT l.file_id, l.name, l.mime, m.export_mime,
    CASE WHEN m.export_mime IS NOT NULL THEN {Q.stem('l.name')} || m.ext
         WHEN {Q.kind('l.name')} IN {Q.SUPPORTED} THEN l.name END AS target_name,
    CASE WHEN m.export_mime IS NOT NULL THEN 'export' ELSE 'download' END AS action
  FROM v_listing l LEFT JOIN (VALUES
    ('application/vnd.google-apps.document', 'application/pdf', '.pdf'),
    ('application/vnd.google-apps.spreadsheet', 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet', '.xlsx'),
    ('application/vnd.google-apps.presentation', 'application/vnd.openxmlformats-officedocument.presentationml.presentation', '.pptx'))
    AS m(mime, export_mime, ext) ON l.mime = m.mime)
WHERE target_name IS NOT NULL""", "v_listing"))
def q_plan_export(fx: Fixtures):
    return P.plan_export(fx.v_listing()).select("file_id", "name", "mime", "export_mime", "target_name", "action")


@query("drop_empty_text", "P3", f"SELECT name, text, title FROM ({_extract_sql()}) WHERE text <> ''")
def q_drop_empty_text(fx: Fixtures):
    return P.drop_empty_text(X.extract_documents(fx.v_files())).select("name", "text", "title")


_DOC_LINES_SQL = f"""
SELECT n, CAST(generate_subscripts(string_split(text, {NL}), 1) - 1 AS INTEGER) AS chunk_id,
       unnest(string_split(text, {NL})) AS text FROM v_docs"""


def _doc_lines(fx: Fixtures):
    return fx.v_docs().select("n", F.posexplode(F.split(F.col("text"), "\n")).alias("chunk_id", "text")).select(
        "n", F.col("chunk_id").cast("int").alias("chunk_id"), "text"
    )


@query("drop_blank_chunks", "P4", with_views(f"SELECT n, chunk_id, text FROM ({_DOC_LINES_SQL}) WHERE NOT {Q.is_blank('text')}", "v_docs"))
def q_drop_blank_chunks(fx: Fixtures):
    return P.drop_blank_chunks(_doc_lines(fx))


@query("is_blank", "F12", with_views(f"SELECT n, chunk_id, {Q.is_blank('text')} AS blank FROM ({_DOC_LINES_SQL})", "v_docs"))
def q_is_blank(fx: Fixtures):
    return _doc_lines(fx).select("n", "chunk_id", is_blank(F.col("text")).alias("blank"))


@query("build_documents", "P5", with_views(
    "SELECT text, source, coalesce(CASE WHEN n % 5 = 0 THEN NULL ELSE title END, '') AS title FROM v_docs", "v_docs"))
def q_build_documents(fx: Fixtures):
    d = fx.v_docs().withColumn("title", F.when(F.col("n") % 5 == 0, F.lit(None)).otherwise(F.col("title")))
    return P.build_documents(d)


@query("reference_payload", "P6", with_views(
    "SELECT doc_id, chunk_id, source, title, '2026-01-01T00:00:00+00:00' AS created_at FROM v_store", "v_store"))
def q_reference_payload(fx: Fixtures):
    p = P.reference_payload(fx.v_store(), F.to_timestamp(F.lit(BATCH_TS)))
    return p.select("payload.doc_id", "payload.chunk_id", "payload.source", "payload.title", "payload.created_at")



# -- U1: drive files + web pages as one document table ---------------------------------------------

@query("union_sources", "U1", f"""
SELECT text, 'gdrive://' || name AS source, title FROM ({_extract_sql()}) WHERE text <> ''
UNION ALL
SELECT text, source, title FROM ({with_views(_PAGES_SQL, "v_pages")})""")
def q_union_sources(fx: Fixtures):
    from ..operators.aggregates import union_sources

    drive = P.drop_empty_text(X.extract_documents(fx.v_files())).select(
        "text", F.concat(F.lit("gdrive://"), F.col("name")).alias("source"), "title"
    )
    return union_sources(drive, S.scan_pages(fx.v_pages()))
