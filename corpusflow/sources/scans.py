"""Scans of listings, file trees, pages, source configs, the index and poll state.

Network clients (Drive API, git, HTTP) are outside the library: their
output lands as tables (listing rows, cloned trees on shared storage, fetched
pages), and these scans turn those tables into documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import ALL_SUFFIXES, DEFAULT_GLOB
from ..functions.html import html_text, html_title
from ..functions.text import decode_text, glob_regex, is_blank, suffix
from ..operators.joins import indexed_doc_ids
from ..session import ensure_parallel

LISTING_COLUMNS = ("file_id", "name", "mime", "modified_time")
STATE_SCHEMA = T.StructType([
    T.StructField("file_id", T.StringType(), False),
    T.StructField("modified_time", T.StringType(), True),
])
REPO_SPEC = "array<struct<url:string,glob:string>>"


def list_files(catalog: DataFrame, folder: str) -> DataFrame:
    """Files directly in ``folder`` that are not trashed; both predicates reach the scan."""
    return catalog.where((F.col("parent") == F.lit(folder)) & ~F.col("trashed")).select(*LISTING_COLUMNS)


def match_tree(files: DataFrame, specs: DataFrame, path: str = "path", repo: str = "repo") -> DataFrame:
    """S2 (path-table form): files of each repo whose relative path matches the repo's glob
    and whose lower-cased suffix is supported.

    ``specs`` (repo, url, glob) is joined on the repo key; each glob becomes a
    regex column, so one pass handles any number of repos and patterns.
    """
    s = specs.select(F.col(repo).alias("_repo"), F.col("url"), glob_regex(F.coalesce("glob", F.lit(DEFAULT_GLOB))).alias("_re"))
    j = files.join(s, files[repo] == s["_repo"]).drop("_repo")
    ok = F.expr(f"regexp_like(`{path}`, _re)") & F.lower(suffix(F.element_at(F.split(F.col(path), "/"), -1))).isin(*ALL_SUFFIXES)
    return j.where(ok).drop("_re")


def scan_tree(spark: SparkSession, root: str, glob: str = DEFAULT_GLOB) -> DataFrame:
    """S2 on storage: every regular file under ``root`` as (path relative to root, bytes).

    ``binaryFile`` lists files in parallel; the glob is applied to the
    *relative* path (``pathGlobFilter`` only sees the file name). Note: Spark
    file sources skip names starting with ``.`` or ``_``.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    rel = F.regexp_replace(F.col("path"), "^" + _re_escape(full) + "/", "")  # paths of files are qualified, as ``full``
    out = df.select(rel.alias("path"), F.col("content"), F.col("length"))
    regex = glob_regex(F.lit(glob))
    ok = F.expr("regexp_like(path, _re)")
    return (
        out.withColumn("_re", regex).where(ok & F.lower(suffix(F.element_at(F.split("path", "/"), -1))).isin(*ALL_SUFFIXES)).drop("_re")
    )


def _re_escape(s: str) -> str:
    import re

    return re.escape(s)


def read_text(files: DataFrame, content: str = "content") -> DataFrame:
    """S3: bytes -> text (bad UTF-8 -> U+FFFD, CRLF/CR -> LF)."""
    return files.withColumn("text", decode_text(F.col(content)))


def scan_pages(
    pages: DataFrame, url: str = "url", content_type: str = "content_type", body: str = "body"
) -> DataFrame:
    """S4 + E6/E7 + P3: crawled pages -> documents (text, source, title).

    HTML when the content type contains ``html`` in any case: visible text
    joined by blank lines and the ``<title>``; otherwise the body as is and an
    empty title. Pages blank after strip are dropped. No stem fallback for web.
    Other bodies do not enter the parser: it gets NULL for them.
    """
    is_html = F.lower(F.coalesce(F.col(content_type), F.lit(""))).contains("html")
    parsed = html_text(F.when(is_html, F.col(body)), "\n\n")
    text = F.when(is_html, parsed).otherwise(F.col(body))
    title = F.when(is_html, html_title(F.col(body))).otherwise(F.lit(""))
    # The blank filter sits inside a generator so the parsed text is computed once
    # (a plain filter on it would be pushed below the projection and re-parse).
    row = F.struct(text.alias("text"), F.col(url).alias("source"), title.alias("title"))
    kept = F.filter(F.array(row), lambda r: ~is_blank(r["text"]))
    return ensure_parallel(pages).select(F.inline(kept))


def parse_repo_specs(config: DataFrame, col: str = "config") -> DataFrame:
    """JSON list of ``{"url", "glob"}`` -> rows; entries without url dropped,
    glob defaults to ``**/*``; invalid JSON gives no rows."""
    arr = F.from_json(F.col(col), REPO_SPEC)
    keep = [c for c in config.columns if c != col]
    e = config.select(*keep, F.posexplode(arr).alias("pos", "s"))
    return e.where(F.col("s.url").isNotNull() & (F.col("s.url") != "")).select(
        *keep, "pos", F.col("s.url").alias("url"), F.coalesce(F.col("s.glob"), F.lit(DEFAULT_GLOB)).alias("glob")
    )


def parse_url_list(config: DataFrame, col: str = "config") -> DataFrame:
    """S5 for web sources: JSON list of URL strings -> one row per URL."""
    keep = [c for c in config.columns if c != col]
    return config.select(*keep, F.posexplode(F.from_json(F.col(col), "array<string>")).alias("pos", "url")).where(
        F.col("url").isNotNull()
    )


def scan_indexed_docs(points: DataFrame | None, doc: str = "doc_id") -> DataFrame | None:
    """Distinct non-blank ``doc_id`` of the index; only that column is read."""
    if points is None:
        return None
    return indexed_doc_ids(points, doc)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """Saved poll state, or an empty table with the state schema."""
    from ..operators.store import SnapshotTable

    return SnapshotTable(spark, path, STATE_SCHEMA).read()

