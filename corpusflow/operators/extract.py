"""Text and title extraction as DataFrame jobs.

Text-like files (Markdown, plain text, AsciiDoc, reStructuredText, HTML) are
handled in one narrow stage. Office formats arrive as
*parts tables* produced by whatever decoder the user runs (page texts,
paragraphs, shapes, cells); their assembly is an ordered aggregation per
document. Binary decoding itself is not part of this library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import BINARY_SUFFIXES, HTML_SUFFIXES, TEXT_SUFFIXES
from ..functions.html import html_text, html_title
from ..functions.text import is_blank, py_strip, stem, suffix
from ..functions.titles import first_line_title, or_stem, rst_title

NL = "\n"
PARA = "\n\n"
#: Parts of one document that may meet in one task; those of larger documents are joined by key ranges first.
MOST_PARTS = 50_000
#: Documents with more parts than that whose ids may be broadcast; beyond it the join shuffles.
HUGE_DOCS = 100_000


def _ordered_join(order: list[str], value: Column, sep: str) -> Column:
    """Aggregate: ``value`` of the group's rows in ``order``, NULLs skipped, joined by ``sep``."""
    keyed = F.struct(*[F.col(c) for c in order], value.alias("_v"))
    return F.array_join(F.transform(F.sort_array(F.collect_list(keyed)), lambda s: s["_v"]), sep)


def _huge_docs(counted: DataFrame, doc: str, most: int) -> DataFrame | None:
    """Ids (``_huge``) of documents with more than ``most`` rows in ``counted``, None if there is none.

    One aggregation of the id column alone, counted map-side first."""
    sizes = counted.groupBy(F.col(doc).alias("_huge")).agg(F.count(F.lit(1)).alias("_parts"))
    huge = sizes.where(F.col("_parts") > most).select("_huge", F.lit(True).alias("_is_huge"))
    n = huge.limit(HUGE_DOCS + 1).count()
    if n == 0:
        return None
    return F.broadcast(huge) if n <= HUGE_DOCS else huge


def _assembled(
    parts: DataFrame, doc: str, order: list[str], value: Column, sep: str, most: int, counted: DataFrame | None = None
) -> DataFrame:
    """One row per document: ``value`` of its parts in ``order``, NULLs skipped, joined by ``sep``.

    A document of up to ``most`` parts (rows of ``counted``) is one group. The parts of larger ones
    are dealt into ranges of (document, order), joined there in parallel, and only the joined
    ranges, one string per range that the document reaches into, meet per document. Parts of equal
    order share a range and come in the order of their values, as in a group.
    """
    rows = parts.select(doc, *order, value.alias("_v"))

    def joined(rows: DataFrame) -> DataFrame:
        return rows.groupBy(doc).agg(_ordered_join(order, F.col("_v"), sep).alias("text"))

    huge = _huge_docs(parts if counted is None else counted, doc, most)
    if huge is None:
        return joined(rows)
    flagged = rows.join(huge, F.col(doc).eqNullSafe(F.col("_huge")), "left")
    ranges = flagged.where("_is_huge").select(*rows.columns).repartitionByRange(doc, *order)
    # a range is one task's rows, so its list is complete before the exchange and moves as one row
    blocks = ranges.withColumn("_range", F.spark_partition_id()).groupBy(doc, "_range").agg(
        F.when(F.count("_v") > 0, _ordered_join(order, F.col("_v"), sep)).alias("_block"))
    large = blocks.groupBy(doc).agg(_ordered_join(["_range"], F.col("_block"), sep).alias("text"))
    return joined(flagged.where("_is_huge is null").select(*rows.columns)).unionByName(large)


# -- E2-E5: parts tables ---------------------------------------------------------

def assemble_pages(parts: DataFrame, doc: str = "doc", ord_: str = "ord", text: str = "text", most: int = MOST_PARTS) -> DataFrame:
    """PDF: page texts in page order joined by a blank line; a page without text counts as ''."""
    return _assembled(parts, doc, [ord_], F.coalesce(F.col(text), F.lit("")), PARA, most)


def assemble_paragraphs(parts: DataFrame, doc: str = "doc", ord_: str = "ord", text: str = "text", most: int = MOST_PARTS) -> DataFrame:
    """DOCX: paragraphs blank after strip are dropped, the others kept unstripped."""
    keep = F.when(~F.coalesce(is_blank(F.col(text)), F.lit(True)), F.col(text))
    return _assembled(parts, doc, [ord_], keep, PARA, most)


def assemble_shapes(
    parts: DataFrame, doc: str = "doc", order: tuple[str, ...] = ("ord",), text: str = "text", has_text: str = "has_text",
    most: int = MOST_PARTS,
) -> DataFrame:
    """PPTX: shapes with a text frame, in slide then shape order, blanks kept."""
    keep = F.when(F.col(has_text), F.coalesce(F.col(text), F.lit("")))
    return _assembled(parts, doc, list(order), keep, PARA, most)


def assemble_cells(
    cells: DataFrame, doc: str = "doc", sheet: str = "sheet", row: str = "row", col: str = "col", value: str = "value",
    most: int = MOST_PARTS,
) -> DataFrame:
    """XLSX: per row the non-null cells joined by `` | ``; rows without any value
    dropped (a row of empty strings has values and stays);
    rows of all sheets in (sheet, row) order joined by newline.

    Two aggregation levels: the first is keyed by (doc, sheet, row) and so
    spreads even one huge workbook over all tasks; it shrinks the data before
    the per-document shuffle. A workbook of more than ``most`` cells then joins its rows by ranges.
    """
    rows = cells.groupBy(doc, sheet, row).agg(_ordered_join([col], F.col(value), " | ").alias("_r"), F.count(value).alias("_n"))
    rows = rows.select(doc, sheet, row, F.when(F.col("_n") > 0, F.col("_r")).alias("_r"))
    return _assembled(rows, doc, [sheet, row], F.col("_r"), NL, most, counted=cells)


# -- E1 / E10: dispatch by suffix ----------------------------------------------------

def file_kind(name: Column | str) -> Column:
    return F.lower(suffix(name))


def _part_text(kind: Column, content: Column) -> Column:
    """E2-E5 for content that lists a document's parts in its own row: one part per
    line, cells of a sheet row separated by ``", "``. No grouping: parts stay in their row."""
    lines = F.split(content, NL)
    rows = F.transform(lines, lambda line: F.array_join(F.split(line, ", "), " | "))
    return (
        F.when(kind == ".docx", F.array_join(F.filter(lines, lambda x: ~is_blank(x)), PARA))
        .when(kind == ".xlsx", F.array_join(rows, NL))
        .otherwise(F.array_join(lines, PARA))
    )


def extract_documents(
    files: DataFrame, name: str = "name", content: str = "content", title: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``keep..., name, kind, text, title`` for every file, one row each (files of
    one name in different folders stay apart; carry their path or id with ``keep``).

    Text kinds keep their content, HTML its visible text. For PDF/DOCX/PPTX/XLSX the
    content is the decoder's part list. Titles: the heading or ``<title>``; for
    PDF/DOCX/PPTX the metadata title in column ``title`` (stripped), if there is one; then
    the stem of the name. A file that could not be read (NULL content) has empty text, and
    an empty title if it is a text kind. Unknown suffixes give empty text and title.
    """
    from ..session import ensure_parallel

    n, c = F.col(name), F.col(content)
    kind, st = file_kind(n), stem(n)
    is_text, is_html, is_office = kind.isin(*TEXT_SUFFIXES), kind.isin(*HTML_SUFFIXES), kind.isin(*BINARY_SUFFIXES)
    text = (
        F.when(is_text, c)
        .when(is_html, html_text(F.when(is_html, c), NL))
        .when(is_office, _part_text(kind, c))
    )
    stated = F.lit("") if title is None else F.coalesce(py_strip(F.col(title)), F.lit(""))
    found = (
        F.when(kind.isin(".md", ".adoc"), first_line_title(c))
        .when(kind == ".rst", rst_title(c))
        .when(is_html, html_title(c))
        .when(is_office & (kind != ".xlsx"), stated)
    )
    unread = is_text & c.isNull()
    named = F.when((is_text | is_html | is_office) & ~unread, or_stem(F.coalesce(found, F.lit("")), st))
    return ensure_parallel(files).select(
        *keep, n.alias("name"), kind.alias("kind"),
        F.coalesce(text, F.lit("")).alias("text"), F.coalesce(named, F.lit("")).alias("title"),
    )
