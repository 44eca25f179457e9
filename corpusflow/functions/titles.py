"""E8 first-line title, E9 reStructuredText title, E10 title fallback chain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

# Line breaks of Python's str.splitlines(). FIXED VALUES
LINE_BREAK = r"\r\n|[\n\r\x{b}\x{c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"
NOT_LINE_BREAK = r"[^\n\r\x{b}\x{c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"
RST_UNDERLINE = r"^[=\-~^]+$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lines(content: Column | str) -> Column:
    return F.split(_c(content), LINE_BREAK)


def first_line(content: Column | str) -> Column:
    """Text before the first line break (cheaper than splitting the whole text).

    A negated character class is matched iteratively, whatever the line length.
    """
    return F.regexp_extract(_c(content), f"^({NOT_LINE_BREAK}*)", 1)


def first_line_title(content: Column | str) -> Column:
    """Markdown ``# x`` (not ``# # x``) or AsciiDoc ``= x`` (not ``== x``) on the first line only."""
    first = py_strip(first_line(content))
    md = first.startswith("# ") & ~first.startswith("# # ")
    adoc = first.startswith("= ") & ~first.startswith("== ")
    rest = py_strip(F.substring(first, 3, 1 << 30))
    return F.coalesce(F.when(md | adoc, rest), F.lit(""))


def rst_title(content: Column | str) -> Column:
    """First non-blank line whose next line is an underline of = - ~ ^ at least as long.

    ``zip_with`` pairs each line with the next one (the shifted copy is one
    element shorter, so the last line pairs with NULL); one pass per text.
    """
    ls = lines(content)

    def pick(line: Column, nxt_raw: Column) -> Column:
        cur = py_strip(line)
        nxt = py_strip(nxt_raw)
        ok = (cur != "") & nxt.isNotNull() & (nxt != "") & nxt.rlike(RST_UNDERLINE) & (F.length(nxt) >= F.length(cur))
        return F.when(ok, cur)

    found = F.filter(F.zip_with(ls, F.slice(ls, 2, 1 << 30), pick), lambda x: x.isNotNull())
    return F.coalesce(F.get(found, 0), F.lit(""))


def or_stem(title: Column, stem: Column) -> Column:
    """Title, else the file stem, else ''."""
    return F.coalesce(F.nullif(title, F.lit("")), F.nullif(stem, F.lit("")), F.lit(""))
