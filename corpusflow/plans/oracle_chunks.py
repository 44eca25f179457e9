"""SQL twin (DuckDB) of the recursive splitter, for the oracle only.

The separator list is fixed, so the recursion is at most four levels deep and
is unrolled: at level L every node (a span of a document) picks the first
separator at or after its own start index that occurs in it, is cut into
pieces (separator kept at the start), short pieces form runs between long
ones, long pieces become the nodes of level L+1. Nodes that find no separator
are cut into fixed character windows. Each run is merged by a recursive CTE
that walks its windows with prefix sums of the piece lengths. Windows are
stripped, blank ones dropped, and numbered in text order.
"""

from __future__ import annotations

from .oracle_views import WS

SEPS_SQL = ("chr(10) || chr(10)", "chr(10)", "'. '", "' '")
SEP_LEN = (2, 1, 2, 1)


def _choose(s: str) -> str:
    arms = " ".join(f"WHEN r <= {k} AND contains({s}, {SEPS_SQL[k]}) THEN {k}" for k in range(4))
    return f"CASE {arms} ELSE 4 END"


def _sep_of(k: str) -> str:
    return "CASE " + " ".join(f"WHEN {k} = {i} THEN {SEPS_SQL[i]}" for i in range(4)) + " END"


def _seplen_of(k: str) -> str:
    return "CASE " + " ".join(f"WHEN {k} = {i} THEN {SEP_LEN[i]}" for i in range(4)) + " END"


def chunk_sql(docs_sql: str, size: int = 1024, overlap: int = 128) -> str:
    """Query over ``docs_sql`` (columns ``key, t``) -> ``key, chunk_id, text``."""
    step = size - min(overlap, size - 1)
    ctes = [f"d AS ({docs_sql})", "n0 AS (SELECT key, 0 AS b, length(t) AS e, 0 AS r FROM d)"]
    for lv in range(4):
        ctes.append(
            f"k{lv} AS (SELECT n.key, n.b, n.e, n.r, substr(d.t, n.b + 1, n.e - n.b) AS s FROM n{lv} n JOIN d ON d.key = n.key)"
        )
        ctes.append(f"kk{lv} AS (SELECT key, b, e, s, {_choose('s')} AS k FROM k{lv})")
        ctes.append(
            f"p{lv} AS (SELECT key, b AS nb, k, unnest(string_split(s, {_sep_of('k')})) AS part, "
            f"generate_subscripts(string_split(s, {_sep_of('k')}), 1) AS i FROM kk{lv} WHERE k < 4)"
        )
        ctes.append(
            f"q{lv} AS (SELECT key, nb, k, i, CAST(CASE WHEN i = 1 THEN length(part) ELSE length(part) + {_seplen_of('k')} END AS BIGINT) AS len "
            f"FROM p{lv})"
        )
        ctes.append(
            f"c{lv} AS (SELECT key, nb, k, i, len, CAST(nb + sum(len) OVER (PARTITION BY key, nb ORDER BY i) - len AS BIGINT) AS pb, "
            f"CAST(sum(CASE WHEN len >= {size} THEN 1 ELSE 0 END) OVER (PARTITION BY key, nb ORDER BY i) AS BIGINT) AS run_no "
            f"FROM q{lv} WHERE len > 0)"
        )
        ctes.append(f"n{lv + 1} AS (SELECT key, pb AS b, pb + len AS e, k + 1 AS r FROM c{lv} WHERE len >= {size})")
    leaves = " UNION ALL ".join([f"SELECT key, b, e FROM kk{lv} WHERE k = 4" for lv in range(4)] + ["SELECT key, b, e FROM n4"])
    shorts = " UNION ALL ".join(f"SELECT key, {lv} AS lvl, nb, run_no, i, pb, len FROM c{lv} WHERE len < {size}" for lv in range(4))
    ctes.append(f"leaves AS ({leaves})")
    ctes.append(
        f"rl AS (SELECT *, CAST(sum(len) OVER (PARTITION BY key, lvl, nb, run_no ORDER BY i) AS BIGINT) AS cum FROM ({shorts}))"
    )
    ctes.append(
        "runs AS (SELECT key, lvl, nb, run_no, min(pb) AS ub, list(len ORDER BY i) AS lens, list(pb ORDER BY i) AS bs, "
        "list(cum ORDER BY i) AS cums FROM rl GROUP BY key, lvl, nb, run_no)"
    )

    def cb(j: str) -> str:  # sum of the lengths before piece j
        return f"(CASE WHEN {j} = 1 THEN 0 ELSE r.cums[{j} - 1] END)"

    fail = f"(r.cums[w.hi] - {cb('j')} > {overlap} OR r.cums[w.hi] - {cb('j')} + r.lens[w.hi + 1] > {size})"
    nlo = f"(w.lo + len(list_filter(range(w.lo, w.hi + 1), lambda j: {fail})))"
    hi2 = f"len(list_filter(r.cums, lambda c: c <= {cb(nlo)} + {size}))"
    ctes.append(
        "w AS (SELECT key, lvl, nb, run_no, CAST(1 AS BIGINT) AS lo, "
        f"CAST(len(list_filter(cums, lambda c: c <= {size})) AS BIGINT) AS hi, 0 AS wk FROM runs "
        "UNION ALL "
        f"SELECT w.key, w.lvl, w.nb, w.run_no, CAST({nlo} AS BIGINT), CAST({hi2} AS BIGINT), w.wk + 1 "
        "FROM w JOIN runs r ON r.key = w.key AND r.lvl = w.lvl AND r.nb = w.nb AND r.run_no = w.run_no "
        "WHERE w.hi < len(r.cums))"
    )
    ctes.append(
        "wins AS (SELECT w.key, r.ub, w.wk, r.bs[w.lo] AS b, r.bs[w.hi] + r.lens[w.hi] AS e FROM w JOIN runs r "
        "ON r.key = w.key AND r.lvl = w.lvl AND r.nb = w.nb AND r.run_no = w.run_no)"
    )
    ctes.append(
        f"lw AS (SELECT key, b AS ub, m AS wk, b + m * {step} AS b, least(b + m * {step} + {size}, e) AS e "
        f"FROM (SELECT key, b, e, unnest(range(0, greatest(0, CAST(ceil((e - b - {size}) / {step}) AS BIGINT)) + 1)) AS m "
        "FROM leaves))"
    )
    ctes.append(
        f"tx AS (SELECT a.key, a.ub, a.wk, trim(substr(d.t, a.b + 1, a.e - a.b), {WS}) AS text "
        "FROM (SELECT key, ub, wk, b, e FROM wins UNION ALL SELECT key, ub, wk, b, e FROM lw) a JOIN d ON d.key = a.key)"
    )
    body = ",\n".join(ctes)
    return (
        f"WITH RECURSIVE {body}\n"
        "SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY ub, wk) - 1 AS INTEGER) AS chunk_id, text "
        "FROM tx WHERE text <> ''"
    )


def embed_sql(src: str, keys: tuple[str, ...], text: str = "text", dim: int = 64) -> str:
    """Feature-hashing embedder in SQL over ``src``: ``keys..., vector`` (float[dim], L2-normalised)."""
    k = ", ".join(keys)
    on = " AND ".join(f"c.{x} = t.{x}" for x in keys)
    on_g = " AND ".join(f"n.{x} = g.{x}" for x in keys)
    gk = ", ".join(f"g.{x}" for x in keys)
    tk = ", ".join(f"t.{x}" for x in keys)
    return f"""
WITH t AS (SELECT {k}, coalesce({text}, '') AS text FROM ({src})),
tok AS (SELECT {k}, unnest(regexp_extract_all(lower(text), '[\\pL\\pN]+')) AS tok FROM t),
f AS (SELECT {k}, CAST(CAST('0x' || substr(md5(tok), 1, 8) AS UBIGINT) % {dim} AS INTEGER) AS b,
             CASE WHEN CAST('0x' || substr(md5(tok), 9, 1) AS INTEGER) % 2 = 0 THEN 1 ELSE -1 END AS s FROM tok),
c AS (SELECT {k}, b, CAST(sum(s) AS DOUBLE) AS v FROM f GROUP BY {k}, b),
g AS (SELECT {tk}, i.b, coalesce(c.v, 0.0) AS v
      FROM t CROSS JOIN (SELECT CAST(range AS INTEGER) AS b FROM range({dim})) i
      LEFT JOIN c ON {on} AND c.b = i.b),
n AS (SELECT {k}, sqrt(sum(v * v)) AS nrm FROM g GROUP BY {k})
SELECT {gk}, list(CAST(CASE WHEN n.nrm = 0 THEN 0.0 ELSE g.v / n.nrm END AS FLOAT) ORDER BY g.b) AS vector
FROM g JOIN n ON {on_g} GROUP BY {gk}"""


def doc_chunks_sql(docs_sql: str, size: int = 1024, overlap: int = 128) -> str:
    """``docs_sql`` (text, source, title) -> chunk rows ``doc_id, chunk_id, text, source, title``."""
    from .oracle_views import doc_id_sql

    keyed = f"SELECT {doc_id_sql('source')} AS key, text AS t, source, coalesce(title, '') AS title FROM ({docs_sql})"
    return (
        f"SELECT c.key AS doc_id, c.chunk_id, c.text, k.source, k.title FROM ({chunk_sql(keyed, size, overlap)}) c "
        f"JOIN ({keyed}) k ON k.key = c.key"
    )


def points_sql(docs_sql: str, created_at: str | None = "2026-01-01T00:00:00+00:00", collection: str = "documents") -> str:
    """Chunks -> points with point id, payload and hashed vector (the read-only ingest)."""
    from .oracle_views import point_id

    ch = doc_chunks_sql(docs_sql)
    vec = embed_sql(f"SELECT doc_id, chunk_id, text FROM ({ch})", ("doc_id", "chunk_id"))
    ca = f", '{created_at}' AS created_at" if created_at else ""
    return (
        f"SELECT '{collection}' AS collection, {point_id('c.doc_id', 'c.chunk_id')} AS point_id, c.doc_id, c.chunk_id, "
        f"c.source, c.title{ca}, v.vector FROM ({ch}) c JOIN ({vec}) v ON v.doc_id = c.doc_id AND v.chunk_id = c.chunk_id"
    )
