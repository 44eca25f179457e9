"""E6 visible HTML text and E7 ``<title>``.

The text follows the standard library's streaming tokenizer with one
*non-nested* skip flag: every start tag sets the flag to "tag is
script/style/nav/header/footer", only an end tag among those five clears it. So
text right after ``<nav>`` is dropped, text in ``<nav><ul><li>`` is kept. Text
nodes are stripped, empty ones dropped, and an unfinished tail is lost, as the
tokenizer is not closed.

Entities, comments, quoted attributes, raw-text elements and stray ``<`` need a
tokenizer, so the text is one Arrow-batched UDF; the title is a native expression.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .batches import pieces
from .constants import HTML_SKIP_TAGS
from .text import py_strip

#: FIXED VALUE: the title pattern.
TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"

_OPEN, _CLOSE, _TEXT = range(3)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def html_title(html: Column | str) -> Column:
    """First ``<title ...>...</title>`` (any case, across lines), stripped; entities kept; '' if none."""
    return py_strip(F.regexp_extract(_c(html), TITLE_PATTERN, 1))


class _Tokens(HTMLParser):
    """The markup as a flat list of (kind, tag name or text), in document order."""

    def __init__(self, raw: str):
        super().__init__()
        self.seen: list[tuple[int, str]] = []
        self.feed(raw)

    def handle_starttag(self, tag, attrs):
        self.seen.append((_OPEN, tag))

    def handle_endtag(self, tag):
        self.seen.append((_CLOSE, tag))

    def handle_data(self, data):
        self.seen.append((_TEXT, data))


def _shown(tokens: Iterable[tuple[int, str]]) -> Iterator[str]:
    """Text tokens that no skip tag hides, stripped, without empty ones."""
    hidden = False
    for kind, value in tokens:
        listed = kind != _TEXT and value in HTML_SKIP_TAGS
        if kind == _OPEN:
            hidden = listed
        elif kind == _CLOSE:
            hidden = hidden and not listed
        elif not hidden and (part := value.strip()):
            yield part


def parse_text(raw: str | None, sep: str = "\n") -> str | None:
    """Visible text of one page (NULL stays NULL)."""
    return None if raw is None else sep.join(_shown(_Tokens(raw).seen))


@lru_cache(maxsize=None)
def _text_udf(sep: str):
    @F.arrow_udf("string")
    def visible(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            for part in pieces(col):
                yield pa.array([parse_text(x, sep) for x in part], pa.string())

    return visible


def html_text(html: Column | str, sep: str = "\n") -> Column:
    """Visible text parts joined by ``sep`` (``\\n`` for files, ``\\n\\n`` for web pages)."""
    return _text_udf(sep)(_c(html))
