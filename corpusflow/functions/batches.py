"""Arrow batches in pieces, so that a Python worker's memory follows the piece and not the batch."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Characters of a piece, about: one longer text is a piece of its own.
PIECE_CHARS = 1 << 20


def pieces(texts: pa.Array, chars: int = PIECE_CHARS) -> Iterator[list[str | None]]:
    """The texts of a batch as consecutive lists of about ``chars`` characters."""
    part: list[str | None] = []
    held = 0
    for scalar in texts:
        t = scalar.as_py()
        part.append(t)
        held += 16 + len(t or "")
        if held >= chars:
            yield part
            part, held = [], 0
    if part:
        yield part
