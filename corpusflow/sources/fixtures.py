"""Derived input views (``v_*``) built from the driver tables.

The reference reads Drive listings, git trees, crawled pages and office
files; the driver ships TPC-H-like tables plus a document corpus. These views
turn the given tables into the input shapes of every operator, with rules
that are plain column arithmetic so the same rows can be rebuilt in SQL for
the oracle (``plans/oracle_views.py`` holds the SQL twin of each view).

Each view reads whole tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ids
from .tables import read_table

NL = "\n"

# ---------------------------------------------------------------------------
# FIXED VALUES of the fixture rules (shared with the SQL twins)
# ---------------------------------------------------------------------------
EXT_BY_MOD12 = (".md", ".txt", ".adoc", ".rst", ".html", ".htm", ".pdf", ".docx", ".pptx", ".xlsx", ".MD", ".bin")
GDOC = "application/vnd.google-apps.document"
GSHEET = "application/vnd.google-apps.spreadsheet"
GSLIDES = "application/vnd.google-apps.presentation"
OCTET = "application/octet-stream"
BATCH_TS = "2026-01-01 00:00:00"
STORE_TS = "2024-01-01 00:00:00"
LANG_COLLECTIONS = (("en", "america"), ("fr", "europe"), ("de", "europe"), ("de", "archive"), ("es", "spanish"))


def _ext(doc_id: Column) -> Column:
    m = doc_id % 12
    out = F.when(m == 0, F.lit(EXT_BY_MOD12[0]))
    for k, e in enumerate(EXT_BY_MOD12[1:], start=1):
        out = out.when(m == k, F.lit(e))
    return out


def file_name_col(doc_id: Column) -> Column:
    return F.concat(F.lit("doc"), doc_id.cast("string"), _ext(doc_id))


def modified_time_col(doc_id: Column) -> Column:
    day = F.lpad((doc_id % 28 + 1).cast("string"), 2, "0")
    return F.concat(F.lit("2024-01-"), day, F.lit("T00:00:00Z"))


class Fixtures:
    """Lazily built views over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- files and documents ------------------------------------------------
    def v_files(self) -> DataFrame:
        """name, repo, path, content (text) per document; titles put in front for some ids."""
        d = self.table("documents")
        i, t = F.col("doc_id"), F.col("text")
        tid = F.concat(F.lit("T"), i.cast("string"))
        m12 = i % 12
        underline = F.repeat(F.when(i % 10 == 5, F.lit("-")).otherwise(F.lit("=")), F.length(tid) + i % 3)
        title_tag = F.when(i % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("<title>"), tid, F.lit("</title>")))
        html = F.concat(
            F.lit("<html><head>"), title_tag, F.lit("</head><body><nav>menu "), F.col("lang"),
            F.lit("</nav><p>"), F.replace(t, F.lit(NL), F.lit("</p><p>")), F.lit("</p><footer>f</footer></body></html>"),
        )
        content = (
            F.when(i % 97 == 5, F.lit(""))
            .when(m12.isin(0, 10) & (i % 5 == 0), F.concat(F.lit("# "), tid, F.lit(NL + NL), t))
            .when((m12 == 2) & (i % 5 == 0), F.concat(F.lit("= "), tid, F.lit(NL + NL), t))
            .when((m12 == 3) & (i % 5 == 0), F.concat(tid, F.lit(NL), underline, F.lit(NL + NL), t))
            .when(m12.isin(4, 5), html)
            .otherwise(t)
        )
        name = file_name_col(i)
        return d.select(
            i.alias("doc_id"),
            name.alias("name"),
            F.col("source").alias("repo"),
            F.concat(F.col("lang"), F.lit("/"), name).alias("path"),
            content.alias("content"),
        )

    def v_docs(self, d: DataFrame | None = None) -> DataFrame:
        """Documents as the three loaders emit them: source URI, text, title, lang."""
        d = self.table("documents") if d is None else d
        i = F.col("doc_id")
        name = file_name_col(i)
        m3 = i % 3
        source = (
            F.when(m3 == 0, F.concat(F.lit("gdrive://"), name))
            .when(m3 == 1, F.concat(F.lit("https://git.example.org/"), F.col("source"), F.lit(".git@docs/"), name))
            .otherwise(F.concat(F.lit("https://web.example.org/"), F.col("lang"), F.lit("/"), i.cast("string")))
        )
        text = F.when(i % 4 == 1, F.replace(F.col("text"), F.lit(NL), F.lit(NL + NL))).otherwise(F.col("text"))
        title = F.when(m3 == 2, F.lit("")).otherwise(F.concat(F.lit("T"), i.cast("string")))
        return d.select(i.alias("n"), source.alias("source"), text.alias("text"), title.alias("title"), F.col("lang"))

    def v_pages(self) -> DataFrame:
        p = self.table("pages")
        i = F.col("page_id")
        ct = (
            F.when(i % 10 == 0, F.lit("Text/HTML; charset=utf-8"))
            .when(i % 7 == 0, F.lit("text/plain"))
            .otherwise(F.lit("text/html"))
        )
        return p.select(i, F.col("url"), ct.alias("content_type"), F.col("html").alias("body"))

    # -- listing and state ------------------------------------------------------
    def v_listing(self, d: DataFrame | None = None) -> DataFrame:
        d = self.table("documents") if d is None else d
        i = F.col("doc_id")
        m10 = i % 10
        mime = (
            F.when(m10 == 3, F.lit(GDOC)).when(m10 == 6, F.lit(GSHEET)).when(m10 == 9, F.lit(GSLIDES)).otherwise(F.lit(OCTET))
        )
        return d.select(
            F.concat(F.lit("f"), i.cast("string")).alias("file_id"),
            file_name_col(i).alias("name"),
            mime.alias("mime"),
            modified_time_col(i).alias("modified_time"),
            F.when(i % 13 == 0, F.lit("archive")).otherwise(F.lit("root")).alias("parent"),
            (i % 11 == 0).alias("trashed"),
        )

    def v_state(self) -> DataFrame:
        d = self.table("documents")
        i = F.col("doc_id")
        kept = d.where(i % 5 != 0).select(
            F.concat(F.lit("f"), i.cast("string")).alias("file_id"),
            F.when(i % 7 == 0, F.lit("2023-12-31T00:00:00Z")).otherwise(modified_time_col(i)).alias("modified_time"),
        )
        gone = d.where(i % 8 == 3).select(
            F.concat(F.lit("f"), (i + 1000000000).cast("string")).alias("file_id"),
            F.lit("2023-06-01T00:00:00Z").alias("modified_time"),
        )
        return kept.unionByName(gone)

    # -- parts tables for office formats ------------------------------------------
    def v_pages_parts(self) -> DataFrame:
        c = self.table("conversations")
        k = (F.col("conv_id") + F.col("turn")) % 9
        text = F.when(k == 4, F.lit(None).cast("string")).when(k == 7, F.lit("  ")).otherwise(F.col("text"))
        return c.select(
            F.col("conv_id").alias("doc"), F.col("turn").alias("ord"), text.alias("text"),
            (F.col("role") != "system").alias("has_text"),
        )

    def v_cells(self) -> DataFrame:
        """Long format (doc, sheet, row, col, value); one source row per (doc, sheet, row)."""
        from ..session import ensure_parallel

        li = ensure_parallel(self.table("lineitem")).select(
            "l_suppkey", "l_linenumber", "l_orderkey", "l_partkey", "l_extendedprice", "l_linestatus",
            "l_returnflag", "l_quantity",
        )
        w = Window.partitionBy("l_suppkey", "l_linenumber", "l_orderkey").orderBy("l_partkey", "l_extendedprice")
        one = li.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
        c1 = F.when(F.col("l_partkey") % 10 == 0, F.lit(None)).otherwise(F.col("l_partkey").cast("string"))
        c2 = F.when(F.col("l_linestatus") == "O", F.lit(None)).otherwise(F.col("l_returnflag"))
        c3 = F.when(F.col("l_quantity") > 40, F.lit(None)).otherwise(F.col("l_quantity").cast("bigint").cast("string"))
        wide = one.select(
            F.col("l_suppkey").alias("doc"), F.col("l_linenumber").alias("sheet"), F.col("l_orderkey").alias("row"),
            c1.alias("c1"), c2.alias("c2"), c3.alias("c3"),
        )
        return wide.select(
            "doc", "sheet", "row",
            F.expr("stack(3, 1, c1, 2, c2, 3, c3) AS (col, value)"),
        )

    # -- chunk tables --------------------------------------------------------------
    def _lines(self) -> DataFrame:
        d = self.table("documents")
        return d.select(
            F.col("doc_id").alias("n"), F.col("source"),
            F.posexplode(F.split(F.col("text"), NL)).alias("chunk_id", "line"),
        )

    def v_store(self) -> DataFrame:
        l = self._lines().where(F.col("n") % 2 == 0)
        return l.select(
            F.concat(F.lit("d"), F.col("n").cast("string")).alias("doc_id"),
            F.col("chunk_id").cast("int").alias("chunk_id"),
            F.col("line").alias("text"),
            F.col("source"),
            F.concat(F.lit("T"), F.col("n").cast("string")).alias("title"),
            (F.to_timestamp(F.lit(STORE_TS)) + F.make_dt_interval(mins=F.col("n").cast("int"))).alias("created_at"),
        )

    def v_batch(self) -> DataFrame:
        l = self._lines().where(~((F.col("n") % 9 == 0) & (F.col("chunk_id") >= 2)))
        base = l.select(
            F.concat(F.lit("d"), F.col("n").cast("string")).alias("doc_id"),
            F.col("chunk_id").cast("int").alias("chunk_id"),
            F.when(F.col("n") % 4 == 0, F.concat(F.col("line"), F.lit(" [rev]"))).otherwise(F.col("line")).alias("text"),
            F.col("source"),
            F.concat(F.lit("T"), F.col("n").cast("string")).alias("title"),
            F.lit(0).alias("seq"),
            F.col("n"),
        )
        dup = base.where((F.col("n") % 6 == 1) & (F.col("chunk_id") == 0)).select(
            "doc_id", "chunk_id", F.concat(F.col("text"), F.lit(" [v2]")).alias("text"), "source", "title",
            F.lit(1).alias("seq"), "n",
        )
        return base.unionByName(dup).drop("n")

    # -- points, log, registry -------------------------------------------------------
    def v_points(self) -> DataFrame:
        e = self.table("embeddings")
        v = F.col("vec_id")
        doc = F.when(v % 50 == 49, F.lit("")).otherwise(F.concat(F.lit("d"), F.floor(v / 4).cast("bigint").cast("string")))
        coll = F.when(F.col("label") == 0, F.lit("documents")).when(F.col("label") == 1, F.lit("manuals")).otherwise(F.lit("notes"))
        out = e.select(
            v, coll.alias("collection"), doc.alias("doc_id"), (v % 4).cast("int").alias("chunk_id"),
            F.col("embedding").alias("vector"),
        )
        return out.withColumn("point_id", ids.point_id("doc_id", "chunk_id"))

    def v_ingest_log(self) -> DataFrame:
        ev = self.table("events")
        et = F.col("event_type")
        stype = (
            F.when(et == "view", F.lit("web")).when(et.isin("purchase", "signup"), F.lit("drive")).otherwise(F.lit("git"))
        )
        um = F.col("user_id") % 3
        coll = F.when(um == 0, F.lit("documents")).when(um == 1, F.lit("manuals")).otherwise(F.lit("notes"))
        n_chunks = F.floor(F.col("value")).cast("bigint")
        return ev.select(
            F.col("event_id"), F.col("ts"), stype.alias("source_type"), coll.alias("collection"),
            (F.col("user_id") % 5 + 1).alias("n_docs"),
            n_chunks.alias("n_chunks"),
            F.floor((n_chunks + 63) / 64).cast("bigint").alias("embed_requests"),
            (et == "error").cast("bigint").alias("embed_errors"),
            F.when(et == "view", n_chunks % 7).otherwise(F.lit(0)).cast("bigint").alias("skipped"),
            F.col("value").alias("duration_s"),
            (et != "error").alias("ok"),
        )

    def v_registry(self) -> DataFrame:
        r = self.table("region")
        types = F.when(F.col("r_regionkey") % 2 == 0, F.array(F.lit("drive"), F.lit("web"))).otherwise(
            F.array(F.lit("git"), F.lit("web"))
        )
        return r.select(
            F.lower(F.col("r_name")).alias("name"), types.alias("source_types"),
            F.to_timestamp(F.lit(STORE_TS)).alias("updated_at"),
        )

    def lang_routes(self) -> DataFrame:
        """Routing rules lang -> collection (small fixed table, broadcast)."""
        return self.spark.createDataFrame(list(LANG_COLLECTIONS), "lang string, collection string")
