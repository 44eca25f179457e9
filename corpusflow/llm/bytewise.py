"""Vectorised numpy helpers over UTF-8 buffers, used inside Arrow tasks.

Texts of a batch are handled in chunks of about ``CHUNK`` bytes (a longer text
is a chunk of its own), joined with line breaks, so memory follows the chunk and
not the batch. Hashes are 64-bit prefix-sum polynomials modulo 2**64 over random
byte codes, finished with a bit mixer; every task computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CHUNK = 1 << 20
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer with full avalanche, elementwise on uint64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=U) * _BASE) | U(1)
#: The same codes with A-Z equal to a-z.
FOLDED_CODE = BYTE_CODE.copy()
FOLDED_CODE[65:91] = BYTE_CODE[97:123]

_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK + (CHUNK >> 2))
        for k, step in enumerate((_BASE, _INVERSE)):
            p = np.full(size, step, U)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0][:n], _powers[1]


class Rolling:
    """Hashes of arbitrary byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray, codes: np.ndarray = BYTE_CODE):
        power, self._inverse = _power(len(buf) + 1)
        self._sum = np.zeros(len(buf) + 1, U)
        np.cumsum(codes[buf] * power[: len(buf)], out=self._sum[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sum[ends] - self._sum[starts]) * self._inverse[starts]
        return mix(raw + (ends - starts).astype(U) * _BASE)


def chunks(texts: Iterable[str | None], limit: int = CHUNK) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(encoded texts, joined buffer, offsets) per chunk; text i lies at
    ``offsets[i] : offsets[i + 1] - 1``. A null text counts as empty."""
    part: list[bytes] = []
    size = 0
    for text in texts:
        raw = b"" if text is None else text.encode("utf-8", "replace")
        if part and size + len(raw) > limit:
            yield _joined(part)
            part, size = [], 0
        part.append(raw)
        size += len(raw) + 1
    if part:
        yield _joined(part)


def _joined(part: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    buf = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
    offsets = np.zeros(len(part) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in part], out=offsets[1:])
    return part, buf, offsets


def words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word (run of bytes other than ASCII white space)."""
    space = np.ones(len(buf) + 2, np.int8)
    space[1:-1] = IS_SPACE[buf]
    edge = np.flatnonzero(np.diff(space))
    return edge[::2], edge[1::2]


def owner(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the text that holds each position."""
    return np.searchsorted(offsets, starts, "right") - 1


def triples(h: np.ndarray) -> np.ndarray:
    """Hash of each window of three consecutive word hashes."""
    return mix(h[:-2] * U(0xD6E8FEB86659FD93) + h[1:-1] * U(0xA0761D6478BD642F) + h[2:] * U(0xE7037ED1A0B428DB))
