"""Scalar text rules as native column expressions.

All of these stay inside whole-stage codegen; none needs Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import ALL_SUFFIXES, WS_CLASS


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- F12: Python-style blank test and strip ---------------------------------

def py_strip(c: Column | str) -> Column:
    """``str.strip()`` with Python's whitespace set (Spark ``trim`` only removes spaces)."""
    # the lookbehind starts the trailing match only at the beginning of a whitespace
    # run, so a long run inside the text is scanned once (linear, not quadratic)
    return F.regexp_replace(_c(c), f"^{WS_CLASS}+|(?<!{WS_CLASS}){WS_CLASS}++$", "")


def is_blank(c: Column | str) -> Column:
    """True when the text is empty after ``str.strip()``; NULL stays NULL."""
    return F.regexp_like(_c(c), F.lit(f"^{WS_CLASS}*$"))


# -- S3: bytes -> text --------------------------------------------------------

def decode_text(content: Column | str) -> Column:
    """UTF-8 decode with U+FFFD for bad bytes, then universal newlines (CRLF/CR -> LF)."""
    text = F.make_valid_utf8(_c(content).cast("string"))
    return F.regexp_replace(text, "\r\n?", "\n")


# -- F6: file name parts ------------------------------------------------------

def file_name(path: Column | str) -> Column:
    """Last path component."""
    return F.element_at(F.split(_c(path), "/"), -1)


def suffix(name: Column | str) -> Column:
    """Final suffix: a dot and at least one non-dot character, with a non-empty stem before it."""
    return F.regexp_extract(_c(name), r"^(.+)(\.[^.]+)$", 2)


def stem(name: Column | str) -> Column:
    n = _c(name)
    sfx = suffix(n)
    return F.when(sfx == "", n).otherwise(F.substring(n, F.lit(1), F.length(n) - F.length(sfx)))


def is_supported(name: Column | str) -> Column:
    """P1 predicate: lower-cased suffix in the allow-list."""
    return F.lower(suffix(name)).isin(*ALL_SUFFIXES)


# -- F3 / F4 / F5: sources ------------------------------------------------------

def source_type(source: Column | str) -> Column:
    """``gdrive://`` -> drive; http(s) with ``@`` after ``//`` -> git, else web; anything else -> git."""
    s = _c(source)
    is_http = s.startswith("http://") | s.startswith("https://")
    has_at = s.substr(F.instr(s, "//") + 2, F.lit(1 << 30)).contains("@")
    return (
        F.when(s.startswith("gdrive://"), F.lit("drive"))
        .when(is_http & has_at, F.lit("git"))
        .when(is_http, F.lit("web"))
        .otherwise(F.lit("git"))
    )


def drive_uri(name: Column | str) -> Column:
    return F.concat(F.lit("gdrive://"), _c(name))


def repo_uri(repo_url: Column | str, rel_path: Column | str) -> Column:
    return F.concat(_c(repo_url), F.lit("@"), _c(rel_path))


def repo_name(url: Column | str) -> Column:
    """Last URL segment after stripping trailing ``/``, with every ``.git`` removed."""
    last = F.element_at(F.split(F.regexp_replace(_c(url), "/+$", ""), "/"), -1)
    return F.replace(last, F.lit(".git"), F.lit(""))


# -- F8: legacy created_at text -> timestamp ------------------------------------

def migrate_created_at(c: Column | str) -> Column:
    """'' or NULL -> epoch; ISO-8601 text -> timestamp (UTC session)."""
    txt = F.coalesce(F.nullif(_c(c), F.lit("")), F.lit("1970-01-01T00:00:00Z"))
    return F.to_timestamp(txt)


# -- F11: Drive folder URL -> id ---------------------------------------------------

def folder_id_from_url(u: Column | str) -> Column:
    """For Drive URLs take the id after ``folders/``; otherwise keep the value."""
    v = _c(u)
    ext = F.regexp_extract(v, r"folders/([A-Za-z0-9_-]+)", 1)
    return F.when(v.contains("drive.google.com") & (ext != ""), ext).otherwise(v)


# -- S2 helper: glob -> regex ------------------------------------------------------

def glob_regex(glob: Column | str) -> Column:
    """Anchored regex for a path glob: ``**/`` any directories (also none), ``*`` and ``?`` within one segment.

    Built with expressions so a table of per-repo globs becomes a column of
    patterns in one pass.
    """
    g = _c(glob)
    g = F.regexp_replace(g, r"([.+^$(){}|\\])", r"\\$1")
    g = F.replace(g, F.lit("**/"), F.lit("\u0001"))
    g = F.replace(g, F.lit("**"), F.lit("\u0002"))
    g = F.replace(g, F.lit("*"), F.lit("[^/]*"))
    g = F.replace(g, F.lit("?"), F.lit("[^/]"))
    g = F.replace(g, F.lit("\u0001"), F.lit("(?:[^/]*/)*"))
    g = F.replace(g, F.lit("\u0002"), F.lit(".*"))
    return F.concat(F.lit("^"), g, F.lit("$"))
