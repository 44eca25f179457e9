"""SQL twins (DuckDB dialect) of the fixture views in ``sources/fixtures.py``.

``with_views(sql, *names)`` prefixes a query with the CTEs it needs, so each
oracle string is self-contained over the driver's pre-registered tables.
"""

from __future__ import annotations

from ..functions.constants import NAMESPACE_URL_HEX, PY_WHITESPACE

NL = "chr(10)"


def _ws_sql() -> str:
    """The Python whitespace set as a DuckDB string expression."""
    return " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE)


WS = _ws_sql()


def py_strip(x: str) -> str:
    return f"trim({x}, {WS})"


def is_blank(x: str) -> str:
    return f"({py_strip(x)} = '')"


EXT = (
    "CASE doc_id % 12 WHEN 0 THEN '.md' WHEN 1 THEN '.txt' WHEN 2 THEN '.adoc' WHEN 3 THEN '.rst' "
    "WHEN 4 THEN '.html' WHEN 5 THEN '.htm' WHEN 6 THEN '.pdf' WHEN 7 THEN '.docx' WHEN 8 THEN '.pptx' "
    "WHEN 9 THEN '.xlsx' WHEN 10 THEN '.MD' ELSE '.bin' END"
)
NAME = f"('doc' || CAST(doc_id AS VARCHAR) || {EXT})"
MTIME = "('2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z')"
TID = "('T' || CAST(doc_id AS VARCHAR))"

VIEWS: dict[str, str] = {}

VIEWS["v_files"] = f"""
SELECT doc_id, {NAME} AS name, source AS repo, lang || '/' || {NAME} AS path,
  CASE
    WHEN doc_id % 97 = 5 THEN ''
    WHEN doc_id % 12 IN (0, 10) AND doc_id % 5 = 0 THEN '# ' || {TID} || {NL} || {NL} || text
    WHEN doc_id % 12 = 2 AND doc_id % 5 = 0 THEN '= ' || {TID} || {NL} || {NL} || text
    WHEN doc_id % 12 = 3 AND doc_id % 5 = 0 THEN {TID} || {NL}
         || repeat(CASE WHEN doc_id % 10 = 5 THEN '-' ELSE '=' END, CAST(length({TID}) + doc_id % 3 AS INTEGER))
         || {NL} || {NL} || text
    WHEN doc_id % 12 IN (4, 5) THEN '<html><head>'
         || CASE WHEN doc_id % 5 = 0 THEN '' ELSE '<title>' || {TID} || '</title>' END
         || '</head><body><nav>menu ' || lang || '</nav><p>' || replace(text, {NL}, '</p><p>')
         || '</p><footer>f</footer></body></html>'
    ELSE text
  END AS content
FROM documents"""

VIEWS["v_docs"] = f"""
SELECT doc_id AS n,
  CASE doc_id % 3
    WHEN 0 THEN 'gdrive://' || {NAME}
    WHEN 1 THEN 'https://git.example.org/' || source || '.git@docs/' || {NAME}
    ELSE 'https://web.example.org/' || lang || '/' || CAST(doc_id AS VARCHAR)
  END AS source,
  CASE WHEN doc_id % 4 = 1 THEN replace(text, {NL}, {NL} || {NL}) ELSE text END AS text,
  CASE WHEN doc_id % 3 = 2 THEN '' ELSE {TID} END AS title,
  lang
FROM documents"""

VIEWS["v_pages"] = """
SELECT page_id, url,
  CASE WHEN page_id % 10 = 0 THEN 'Text/HTML; charset=utf-8' WHEN page_id % 7 = 0 THEN 'text/plain' ELSE 'text/html' END
    AS content_type,
  html AS body
FROM pages"""

VIEWS["v_listing"] = f"""
SELECT 'f' || CAST(doc_id AS VARCHAR) AS file_id, {NAME} AS name,
  CASE doc_id % 10 WHEN 3 THEN 'application/vnd.google-apps.document'
    WHEN 6 THEN 'application/vnd.google-apps.spreadsheet'
    WHEN 9 THEN 'application/vnd.google-apps.presentation' ELSE 'application/octet-stream' END AS mime,
  {MTIME} AS modified_time,
  CASE WHEN doc_id % 13 = 0 THEN 'archive' ELSE 'root' END AS parent,
  (doc_id % 11 = 0) AS trashed
FROM documents"""

VIEWS["v_state"] = f"""
SELECT 'f' || CAST(doc_id AS VARCHAR) AS file_id,
  CASE WHEN doc_id % 7 = 0 THEN '2023-12-31T00:00:00Z' ELSE {MTIME} END AS modified_time
FROM documents WHERE doc_id % 5 <> 0
UNION ALL
SELECT 'f' || CAST(doc_id + 1000000000 AS VARCHAR), '2023-06-01T00:00:00Z' FROM documents WHERE doc_id % 8 = 3"""

VIEWS["v_pages_parts"] = """
SELECT conv_id AS doc, turn AS ord,
  CASE WHEN (conv_id + turn) % 9 = 4 THEN NULL WHEN (conv_id + turn) % 9 = 7 THEN '  ' ELSE text END AS text,
  (role <> 'system') AS has_text
FROM conversations"""

VIEWS["v_cells"] = """
SELECT doc, sheet, "row", col, value FROM (
  SELECT l_suppkey AS doc, l_linenumber AS sheet, l_orderkey AS "row",
    CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS c1,
    CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_returnflag END AS c2,
    CASE WHEN l_quantity > 40 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS c3
  FROM (
    SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber, l_orderkey
                                 ORDER BY l_partkey, l_extendedprice) AS rn
    FROM lineitem) WHERE rn = 1
) w, LATERAL (VALUES (1, c1), (2, c2), (3, c3)) AS t(col, value)"""

LINES = f"""
SELECT doc_id AS n, source, unnest(string_split(text, {NL})) AS line,
       CAST(generate_subscripts(string_split(text, {NL}), 1) - 1 AS INTEGER) AS chunk_id
FROM documents"""

VIEWS["v_lines"] = LINES

VIEWS["v_store"] = """
SELECT 'd' || CAST(n AS VARCHAR) AS doc_id, chunk_id, line AS text, source, 'T' || CAST(n AS VARCHAR) AS title,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(n AS BIGINT)) AS created_at
FROM v_lines WHERE n % 2 = 0"""

VIEWS["v_batch"] = """
WITH base AS (
  SELECT 'd' || CAST(n AS VARCHAR) AS doc_id, chunk_id,
    CASE WHEN n % 4 = 0 THEN line || ' [rev]' ELSE line END AS text,
    source, 'T' || CAST(n AS VARCHAR) AS title, 0 AS seq, n
  FROM v_lines WHERE NOT (n % 9 = 0 AND chunk_id >= 2))
SELECT doc_id, chunk_id, text, source, title, seq FROM base
UNION ALL
SELECT doc_id, chunk_id, text || ' [v2]', source, title, 1 FROM base WHERE n % 6 = 1 AND chunk_id = 0"""

POINT_ID = "CAST(CAST(('0x' || substr(sha256({d} || ':' || CAST({c} AS VARCHAR)), 1, 16)) AS UBIGINT) AS DECIMAL(20,0))"


def point_id(d: str, c: str) -> str:
    return POINT_ID.format(d=d, c=c)


VIEWS["v_points"] = f"""
SELECT vec_id, collection, doc_id, chunk_id, vector, {point_id('doc_id', 'chunk_id')} AS point_id FROM (
  SELECT vec_id,
    CASE WHEN label = 0 THEN 'documents' WHEN label = 1 THEN 'manuals' ELSE 'notes' END AS collection,
    CASE WHEN vec_id % 50 = 49 THEN '' ELSE 'd' || CAST(vec_id // 4 AS VARCHAR) END AS doc_id,
    CAST(vec_id % 4 AS INTEGER) AS chunk_id, embedding AS vector
  FROM embeddings)"""

VIEWS["v_ingest_log"] = """
SELECT event_id, ts,
  CASE WHEN event_type = 'view' THEN 'web' WHEN event_type IN ('purchase', 'signup') THEN 'drive' ELSE 'git' END
    AS source_type,
  CASE user_id % 3 WHEN 0 THEN 'documents' WHEN 1 THEN 'manuals' ELSE 'notes' END AS collection,
  user_id % 5 + 1 AS n_docs,
  CAST(floor(value) AS BIGINT) AS n_chunks,
  (CAST(floor(value) AS BIGINT) + 63) // 64 AS embed_requests,
  CAST(event_type = 'error' AS BIGINT) AS embed_errors,
  CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) % 7 ELSE 0 END AS skipped,
  value AS duration_s,
  (event_type <> 'error') AS ok
FROM events"""

VIEWS["v_registry"] = """
SELECT lower(r_name) AS name,
  CASE WHEN r_regionkey % 2 = 0 THEN ['drive', 'web'] ELSE ['git', 'web'] END AS source_types,
  TIMESTAMP '2024-01-01 00:00:00' AS updated_at
FROM region"""

VIEWS["lang_routes"] = """
SELECT * FROM (VALUES ('en', 'america'), ('fr', 'europe'), ('de', 'europe'), ('de', 'archive'), ('es', 'spanish'))
  AS t(lang, collection)"""

DEPENDS = {"v_store": ("v_lines",), "v_batch": ("v_lines",)}


def source_type_sql(s: str) -> str:
    return (
        f"CASE WHEN starts_with({s}, 'gdrive://') THEN 'drive' "
        f"WHEN (starts_with({s}, 'http://') OR starts_with({s}, 'https://')) "
        f"AND strpos(substr({s}, strpos({s}, '//') + 2), '@') > 0 THEN 'git' "
        f"WHEN starts_with({s}, 'http://') OR starts_with({s}, 'https://') THEN 'web' ELSE 'git' END"
    )


def doc_id_sql(s: str) -> str:
    h = f"sha1(unhex('{NAMESPACE_URL_HEX}') || encode({s}))"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3) || '-' || "
        f"substr({h}, 21, 12))"
    )


def with_views(sql: str, *names: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, ()):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in order)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
