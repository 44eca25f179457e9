"""DuckDB expression builders used by the oracle strings (independent SQL restatements)."""

from __future__ import annotations

from .oracle_views import WS, py_strip

SUPPORTED = "('.md', '.txt', '.adoc', '.rst', '.html', '.htm', '.pdf', '.docx', '.pptx', '.xlsx')"
LINE_BREAK = r"\r\n|[\n\r\x{b}\x{c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"


def suffix(n: str) -> str:
    return f"regexp_extract({n}, '^(.+)(\\.[^.]+)$', 2)"


def stem(n: str) -> str:
    s = suffix(n)
    return f"(CASE WHEN {s} = '' THEN {n} ELSE substr({n}, 1, length({n}) - length({s})) END)"


def kind(n: str) -> str:
    return f"lower({suffix(n)})"


def or_stem(t: str, st: str) -> str:
    return f"coalesce(nullif({t}, ''), nullif({st}, ''), '')"


def html_title(h: str) -> str:
    return py_strip(f"regexp_extract({h}, '(?is)<title[^>]*>(.*?)</title>', 1)")


# entity name -> SQL replacement; &amp; last
ENTITIES_SQL = (
    ("&lt", "'<'"), ("&gt", "'>'"), ("&quot", "'\"'"), ("&#39", "''''"), ("&nbsp", "chr(160)"), ("&amp", "'&'"),
)


def html_text(h: str, sep_sql: str) -> str:
    x = f"regexp_replace({h}, '(?is)<(script|style)\\b[^>]*>.*?</(script|style)\\s*>', chr(1), 'g')"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', chr(1), 'g')"
    x = f"regexp_replace({x}, '(?i)<(nav|header|footer)\\b[^>]*>[^<]*', chr(1), 'g')"
    parts = f"string_split_regex({x}, chr(1) || '|<[^>]*>')"
    dec = "p"
    for ent, ch in ENTITIES_SQL:  # also without ';' (legacy forms)
        dec = f"regexp_replace({dec}, '{ent};?', {ch}, 'g')"
    cleaned = f"list_transform({parts}, lambda p: {py_strip(dec)})"
    return f"array_to_string(list_filter({cleaned}, lambda q: q <> ''), {sep_sql})"


def first_line_title(c: str) -> str:
    first = py_strip(f"regexp_extract({c}, '^([^\\n\\r\\x{{b}}\\x{{c}}\\x{{1c}}\\x{{1d}}\\x{{1e}}\\x{{85}}\\x{{2028}}\\x{{2029}}]*)', 1)")
    return (
        f"(CASE WHEN (starts_with({first}, '# ') AND NOT starts_with({first}, '# # ')) "
        f"OR (starts_with({first}, '= ') AND NOT starts_with({first}, '== ')) "
        f"THEN {py_strip(f'substr({first}, 3)')} ELSE '' END)"
    )


def rst_title(c: str) -> str:
    ls = f"string_split_regex({c}, '{LINE_BREAK}')"
    cur = py_strip("ls[i]")
    nxt = py_strip("ls[i + 1]")
    cond = (
        f"{cur} <> '' AND {nxt} <> '' AND regexp_full_match({nxt}, '[=\\-~^]+') "
        f"AND length({nxt}) >= length({cur})"
    )
    pick = f"list_filter(list_transform(range(1, len(ls)), lambda i: CASE WHEN {cond} THEN {cur} END), lambda z: z IS NOT NULL)"
    return f"coalesce((SELECT {pick}[1] FROM (SELECT {ls} AS ls)), '')"


def is_blank(x: str) -> str:
    return f"({py_strip(x)} = '')"


__all__ = ["WS", "suffix", "stem", "kind", "or_stem", "html_title", "html_text", "first_line_title", "rst_title", "is_blank"]
