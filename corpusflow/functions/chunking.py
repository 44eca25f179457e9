"""F7 recursive text splitter, P4 blank-chunk removal, W1 chunk numbering.

The splitter follows the public contract of a recursive character splitter
with the separator kept at the start of the following piece, stripped
windows and lengths counted in code points:

1. pick the first separator that occurs in the piece (else ""), cut so every
   later piece starts with it, drop empty pieces;
2. pieces shorter than ``size`` collect in a run; a piece of length >= size
   flushes the run (through the window merge), then is split again with the
   remaining separators (emitted as is if none remain);
3. the merge emits a stripped window whenever adding the next piece would pass
   ``size`` and then drops pieces from the front while the window is longer
   than ``overlap`` (or the next piece still would not fit);
4. no overlap crosses a flush; blank windows are dropped.

The Arrow UDF returns the chunk strings of a few texts at a time. They are sliced in Python, where a
slice costs its own length; ``substring`` on the JVM walks a UTF-8 text from its
start for every chunk, which is quadratic in the length of a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import pieces
from .constants import CHUNK_OVERLAP, CHUNK_SEPARATORS, CHUNK_SIZE


def _strip_span(text: str, b: int, e: int) -> tuple[int, int]:
    while b < e and text[b].isspace():
        b += 1
    while e > b and text[e - 1].isspace():
        e -= 1
    return b, e


def _cut(text: str, b: int, e: int, sep: str) -> list[tuple[int, int]]:
    """Pieces of text[b:e]; each piece after the first starts with ``sep``."""
    if sep == "":
        return [(i, i + 1) for i in range(b, e)]
    starts = []
    step = len(sep)
    pos = text.find(sep, b, e)
    while pos != -1:
        starts.append(pos)
        pos = text.find(sep, pos + step, e)
    bounds = [b, *starts, e]
    return [(bounds[k], bounds[k + 1]) for k in range(len(bounds) - 1) if bounds[k + 1] > bounds[k]]


def _emit(text: str, b: int, e: int, out: list) -> None:
    b, e = _strip_span(text, b, e)
    if e > b:
        out.append((b, e))


def _windows(text: str, b: int, e: int, size: int, overlap: int, out: list) -> None:
    """Merge of one-character pieces over text[b:e]: fixed windows and step."""
    n = e - b
    step = size - min(overlap, size - 1)
    start = 0
    while True:
        _emit(text, b + start, b + min(start + size, n), out)
        if start + size >= n:
            break
        start += step


def _merge(text: str, run: list[tuple[int, int]], size: int, overlap: int, out: list) -> None:
    window_lo = 0  # index into run of the first piece of the current window
    total = 0
    for i, (b, e) in enumerate(run):
        ln = e - b
        if total + ln > size and i > window_lo:
            _emit(text, run[window_lo][0], run[i - 1][1], out)
            while total > overlap or (total + ln > size and total > 0):
                total -= run[window_lo][1] - run[window_lo][0]
                window_lo += 1
        total += ln
    if window_lo < len(run):
        _emit(text, run[window_lo][0], run[-1][1], out)


def _split(text: str, b: int, e: int, seps: tuple[str, ...], size: int, overlap: int, out: list) -> None:
    sep = seps[-1]
    rest: tuple[str, ...] = ()
    for k, s in enumerate(seps):
        if s == "":
            sep = s
            break
        if text.find(s, b, e) != -1:
            sep, rest = s, seps[k + 1 :]
            break
    if sep == "" and size > 1:
        # every piece is one character, so the whole range is a single run
        _windows(text, b, e, size, overlap, out)
        return
    run: list[tuple[int, int]] = []
    for pb, pe in _cut(text, b, e, sep):
        if pe - pb < size:
            run.append((pb, pe))
            continue
        if run:
            _merge(text, run, size, overlap, out)
            run = []
        if rest:
            _split(text, pb, pe, rest, size, overlap, out)
        elif text[pb:pe].strip():
            out.append((pb, pe))
    if run:
        _merge(text, run, size, overlap, out)


def chunk_spans(
    text: str | None,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: tuple[str, ...] = CHUNK_SEPARATORS,
) -> list[tuple[int, int]]:
    """Non-blank chunk spans ``[begin, end)`` of ``text`` in code points."""
    if overlap > size:
        raise ValueError(f"overlap {overlap} is larger than size {size}")
    if not text:
        return []
    out: list[tuple[int, int]] = []
    _split(text, 0, len(text), tuple(separators), size, overlap, out)
    return out


def chunk_text(text: str | None, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> list[str]:
    """Driver-side helper with the same contract (used by tests)."""
    return [text[b:e] for b, e in chunk_spans(text, size, overlap)]


@lru_cache(maxsize=None)
def _chunk_udf(size: int, overlap: int, separators: tuple[str, ...]):
    if overlap > size:
        raise ValueError(f"overlap {overlap} is larger than size {size}")

    @F.arrow_udf("array<string>")
    def chunks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in pieces(texts):
                offsets = np.zeros(len(part) + 1, dtype=np.int32)
                cut: list[str] = []
                for i, t in enumerate(part):
                    cut.extend(t[b:e] for b, e in chunk_spans(t, size, overlap, separators))
                    offsets[i + 1] = len(cut)
                yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(cut, pa.string()))

    return chunks


def chunk_list(
    text: Column | str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: tuple[str, ...] = CHUNK_SEPARATORS,
) -> Column:
    """Column of non-blank chunk texts (Arrow UDF; the only Python in the chunk stage)."""
    col = F.col(text) if isinstance(text, str) else text
    return _chunk_udf(int(size), int(overlap), tuple(separators))(col)


def chunk_documents(
    docs: DataFrame,
    text_col: str = "text",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    keep: tuple[str, ...] | None = None,
    chunk_col: str = "chunk_text",
) -> DataFrame:
    """F7 + P4 + W1: one row per non-blank chunk, numbered 0.. within its document.

    Narrow: no shuffle. ``posexplode`` numbers the already-filtered chunks in
    order, so ``chunk_id`` is the offset after blank removal. ``keep`` lists the
    columns carried next to each chunk (default: all but the text).
    """
    from ..session import ensure_parallel

    keep = tuple(c for c in docs.columns if c != text_col) if keep is None else keep
    # The chunks are an array *before* the explode, so the document text is dropped
    # ahead of the generator: a chunk row never carries a copy of its whole document.
    arrays = ensure_parallel(docs).select(*keep, chunk_list(text_col, size, overlap).alias("_c"))
    # posexplode_outer: a plain posexplode makes Catalyst infer ``size(_c) > 0`` and
    # push it below the repartition, which would run the splitter twice.
    exploded = arrays.select(*keep, F.posexplode_outer("_c").alias("chunk_id", chunk_col)).where(F.col(chunk_col).isNotNull())
    return exploded.select(*keep, F.col("chunk_id").cast("int").alias("chunk_id"), chunk_col)
