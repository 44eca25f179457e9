"""Personal data with offset-preserving deobfuscation.

The base finders run over the whole text. Transducers rewrite the text one after
the other (look-alike characters, boxed at and dot, spelled digits, bare at and
dot), each judging the text its predecessors left and keeping the source span of
every character it emits; the same finders run over the result, and finds map
back to source spans. A find that overlaps a base span is dropped, so base spans
stay as they are.

Defined cases: a null text counts as empty and has no spans; repeated rows are
alike; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, place of the kind in KINDS, end
Edit = tuple[int, int, list[tuple[str, int, int]]]  # place [a, b) becomes characters, each with its own place

_LOCAL_BYTE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A failed try inside a run of digits fails from each later digit too, so tries
# start at run heads only, which keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")


def _luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(twice) + sum(map(int, digits[-1::-2]))) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL_BYTE:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        floor = found.end() if found else at + 1
        at = text.find("@", floor)


def find(text: str) -> list[Span]:
    """Spans of all four kinds, ordered by start, then kind."""
    spans: list[Span] = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0]) if len(m[0]) >= 14 else ""
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


# Letters of other scripts that look like ASCII ones, and marks
# that stand for @ . + - or a blank.
_LOOK_ALIKE = dict(zip(
    "АВЕКМНОРСТУХаеорсухіјѕԁһѵԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρɑɡıⅼ。．․‧・﹒＠﹫‐‑‒–—−﹣－＋﹢    　",
    "ABEKMHOPCTYXaeopcyxijsdhvwABEZHIKMNOPTYXovpagil......@@--------++     ", strict=True))
#: Characters that show nothing and go.
_HIDDEN = "­​‌‍⁠﻿"
_DIGITS = {w: str(k) for k, names in enumerate((
    ("zero", "oh", "null", "cero", "zéro"), ("one", "eins", "uno", "un"), ("two", "zwei", "dos", "deux"),
    ("three", "drei", "tres", "trois"), ("four", "vier", "cuatro", "quatre"), ("five", "fünf", "cinco", "cinq"),
    ("six", "sechs", "seis"), ("seven", "sieben", "siete", "sept"), ("eight", "acht", "ocho", "huit"),
    ("nine", "neun", "nueve", "neuf"))) for w in names}
#: Digits a find has at least (an address has four); fewer are not rewritten.
FEWEST = 4
_WORD = "|".join(sorted(_DIGITS, key=len, reverse=True))
_DIGIT = rf"(?:[0-9]++|{_WORD})(?![^\W_])"
#: Digits and digit words, in a row or with spelled dots between them.
_NUMBER = re.compile(rf"(?<![^\W_]){_DIGIT}(?:(?:[ ().,\-]{{1,3}}|\s{{1,3}}dot\s{{1,3}}){_DIGIT})++", re.IGNORECASE)
_PART = re.compile(rf"[0-9]++|{_WORD}", re.IGNORECASE)
_PLUS = re.compile(r"(?<![^\W_])plus\s{1,2}[0-9]", re.IGNORECASE)
_LETTER = re.compile(r"[^\W\d_]")
_OPEN, _SHUT = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
_BOXED_AT = re.compile(rf"(?<=[A-Za-z0-9]){_OPEN}(?:at|@){_SHUT}(?=[A-Za-z0-9])", re.IGNORECASE)
_BOXED_DOT = re.compile(rf"(?<=[A-Za-z0-9]){_OPEN}(?:dot|\.){_SHUT}(?=[A-Za-z0-9])", re.IGNORECASE)
#: "name at host dot tld": bare words count only as a whole.
_BARE = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?P<at>\s{1,3}at\s{1,3})[A-Za-z0-9-]{1,63}(?:(?:\.|\s{1,3}dot\s{1,3})[A-Za-z0-9-]{1,63}){0,4}?"
    r"(?:\s{1,3}dot\s{1,3})[A-Za-z]{2,24}(?![A-Za-z0-9])", re.IGNORECASE)
_BARE_DOT = re.compile(r"\s{1,3}dot\s{1,3}", re.IGNORECASE)
_HOST_DOT = re.compile(r"(?<=[A-Za-z0-9])\s{1,3}dot\s{1,3}(?=[A-Za-z]{2,24}\b)", re.IGNORECASE)
_AT_HOST = re.compile(r"@[A-Za-z0-9.-]{1,63}\Z")
_HOST_PART = re.compile(r"[A-Za-z0-9.-]{1,63}")
_DOT_ANY = re.compile(r"\sdot\s", re.IGNORECASE)
_HIDDEN_ANY = re.compile("[" + re.escape("".join(_LOOK_ALIKE) + _HIDDEN) + "！-～٠-٩۰-۹०-९\U0001d400-\U0001d7ff]")
_BOX_ANY = re.compile(r"[\[({<]\s{0,3}(?:at|dot|@|\.)\s{0,3}[\])}>]", re.IGNORECASE)


class Traced:
    """A text whose characters know the source span they came from."""

    def __init__(self, text: str, start: Sequence[int], end: Sequence[int]):
        self.text, self.start, self.end = text, start, end

    def rewrite(self, edits: list[Edit]) -> Traced:
        """Replace places [a, b) by characters, each with its own place [x, y)."""
        if not edits:
            return self
        text, start, end, at = [], [], [], 0
        for a, b, chars in edits:
            text.append(self.text[at:a])
            start += self.start[at:a]
            end += self.end[at:a]
            for c, x, y in chars:
                text.append(c)
                start.append(self.start[x])
                end.append(self.end[y - 1])
            at = b
        start += self.start[at:]
        end += self.end[at:]
        return Traced("".join(text) + self.text[at:], start, end)


def _plain(c: str) -> str:
    """What a single character stands for; empty if it shows nothing."""
    if c in _HIDDEN:
        return ""
    if c in _LOOK_ALIKE:
        return _LOOK_ALIKE[c]
    if (d := unicodedata.digit(c, None)) is not None and unicodedata.category(c) == "Nd":
        return str(d)
    wide = unicodedata.normalize("NFKC", c)
    return wide if len(wide) == 1 and wide.isascii() else c


def look_alikes(t: Traced) -> Traced:
    if t.text.isascii():
        return t
    return t.rewrite([(m.start(), m.end(), [(p, m.start(), m.end())] if (p := _plain(m[0])) else []) for m in _HIDDEN_ANY.finditer(t.text)])


def boxed(t: Traced) -> Traced:
    if not _BOX_ANY.search(t.text):
        return t
    for pattern, char in ((_BOXED_AT, "@"), (_BOXED_DOT, ".")):
        t = t.rewrite([(m.start(), m.end(), [(char, m.start(), m.end())]) for m in pattern.finditer(t.text)])
    return t


def bare(t: Traced) -> Traced:
    if "dot" not in t.text.casefold() or not _DOT_ANY.search(t.text):
        return t
    edits: list[Edit] = []
    for m in _BARE.finditer(t.text):
        edits.append((*m.span("at"), [("@", *m.span("at"))]))
        edits += [(*d.span(), [(".", *d.span())]) for d in _BARE_DOT.finditer(t.text, m.end("at"), m.end())]
    t = t.rewrite(edits)
    # a host after an @ may still spell its dots, each after the one before it
    edits, last = [], -1
    for d in _HOST_DOT.finditer(t.text):
        follows = last >= 0 and _HOST_PART.fullmatch(t.text, last, d.start())
        if follows or _AT_HOST.search(t.text[max(0, d.start() - 64) : d.start()]):
            edits.append((*d.span(), [(".", *d.span())]))
            last = d.end()
    return t.rewrite(edits)


def _digit(word: str) -> str:
    return _DIGITS[word.casefold().replace("ı", "i")]  # the patterns ignore case, which takes ı for i and ſ for s


def _number(text: str, m: re.Match[str]) -> list[Edit]:
    """Edits that turn a number's digit words into digits and its spelled dots into dots.

    Separators between words go, unless three dots part the four groups of an address;
    those beside digits and brackets stay, for the finders to judge."""
    parts = [p.span() for p in _PART.finditer(text, m.start(), m.end())]
    sizes = [b - a if text[a].isdecimal() else 1 for a, b in parts]
    gaps = [(b, a) for (_, b), (a, _) in zip(parts, parts[1:], strict=False)]
    dots = [text[a:b] == "." or "dot" in text[a:b].lower() for a, b in gaps]
    if sum(sizes) < FEWEST:
        return []
    ends = [k + 1 for k, d in enumerate(dots) if d]
    address = len(ends) == 3 and all(sum(sizes[a:b]) <= 3 for a, b in zip([0, *ends], [*ends, len(sizes)], strict=True))
    edits: list[Edit] = []
    for k, (a, b) in enumerate(parts):
        if not text[a].isdecimal():
            edits.append((a, b, [(_digit(text[a:b]), a, b)]))
        if k < len(gaps):
            x, y = gaps[k]
            if text[x:y] != "." and dots[k]:
                edits.append((x, y, [(".", x, y)]))
            elif text[a].isdecimal() or text[y].isdecimal() or dots[k] and address or y - x > 2 or "(" in text[x:y] or ")" in text[x:y]:
                continue
            else:
                edits.append((x, y, []))
    return edits


def spelled_digits(t: Traced) -> Traced:
    t = t.rewrite([e for m in _NUMBER.finditer(t.text) if _LETTER.search(m[0]) for e in _number(t.text, m)])
    if "plus" not in t.text.casefold():
        return t
    return t.rewrite([(m.start(), m.end() - 1, [("+", m.start(), m.end() - 1)]) for m in _PLUS.finditer(t.text)])


def spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those found under disguises."""
    if not text:
        return [], []
    base = find(text)
    traced = plain = Traced(text, range(len(text)), range(1, len(text) + 1))
    for step in (look_alikes, boxed, spelled_digits, bare):
        traced = step(traced)
    if traced is plain:
        return base, base
    taken = sorted((a, b) for a, _, b in base)
    every = set(base)
    for a, kind, b in find(traced.text):
        start, end = traced.start[a], traced.end[b - 1]
        if all(end <= x or y <= start for x, y in taken):
            every.add((start, kind, end))
    return base, sorted(every)


def shown(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def redact(text: str | None, found: list[Span]) -> str | None:
    """Each span becomes its kind in brackets; of overlapping spans the first counts."""
    if not found:
        return text
    out, at = [], 0
    for a, k, b in found:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, base_sha256, spans and n_added per row."""
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, digest, listed, added = [[] for _ in KINDS], [], [], []
            for text in batch.column(1).to_pylist():
                base, every = spans(text)
                for k, c in enumerate(counts):
                    c.append(sum(s[1] == k for s in base))
                digest.append(hashlib.sha256(shown(base).encode()).hexdigest())
                listed.append(shown(every))
                added.append(len(every) - len(base))
            columns = [*(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array(listed, pa.string()), pa.array(added, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    shape = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, shape)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind; other columns stay."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            clean = [redact(t, spans(t)[1]) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns[:at], pa.array(clean, pa.string()), *batch.columns[at + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"))
