"""Two-stage suffix sorting of one bounded byte block with numpy.

Suffixes smaller than their successor (type B) are sorted directly, by blocks of
eight bytes and only as deep as ties last. The others (type A) are induced by one
scan of the buckets of first bytes, in rising order: a type A suffix follows from
the place of its successor. Only suffixes that are asked for, and those they are
induced from, take part.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


def _words(text: np.ndarray, depth: int) -> np.ndarray:
    """At each place, the next eight bytes as one big-endian number."""
    padded = np.concatenate((text, np.zeros(depth + 16, np.uint8))).astype(U)
    out = np.zeros(len(padded) - 7, U)
    for k in range(8):
        out = (out << U(8)) | padded[k : len(padded) - 7 + k]
    return out


def _is_smaller(text: np.ndarray) -> np.ndarray:
    """Type B: the suffix is smaller than its successor (equal bytes take the type
    of the next different pair; the last suffix is of type A)."""
    step = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    n = len(text)
    place = np.where(step != 0, np.arange(n - 1), n - 1)
    place = np.minimum.accumulate(place[::-1])[::-1]
    return np.append(np.append(step, -1)[place] > 0, False)


def _sorted(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Direct sort of suffixes by their first ``depth`` bytes."""
    order = places[np.argsort(words[places], kind="stable")]
    head = np.append(True, words[order][1:] != words[order][:-1])
    for d in range(8, depth, 8):
        tied = np.flatnonzero(~head | np.append(~head[1:], False))
        if not len(tied):
            break
        group = np.cumsum(head)[tied]
        word = words[order[tied] + d]
        by = np.lexsort((word, group))
        order[tied] = order[tied][by]
        word = word[by]
        head[tied[1:]] |= word[1:] != word[:-1]  # groups stay where they were, so their heads stay too
    return order


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places marked in ``wanted`` in the order of their suffixes' first ``depth``
    bytes, and the eight-byte words of the text."""
    text = np.append(text, np.array([0, 255], np.uint8))
    need = np.append(wanted, [False, False])
    smaller = _is_smaller(text)
    grown = np.flatnonzero(need & ~smaller) + 1
    while len(grown := grown[~need[grown]]):
        need[grown] = True
        grown = grown[~smaller[grown]] + 1
    words = _words(text, depth)
    direct = _sorted(np.flatnonzero(need & smaller), words, depth)
    induced = need & ~smaller
    cuts = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        own = [x for x in waiting[c] if len(x)]
        for x in own:  # grows while runs of one byte are induced
            before = x[x > 0] - 1
            before = before[induced[before] & (text[before] == c)]
            if len(before):
                own.append(before)
        bucket = np.concatenate([*own, direct[cuts[c] : cuts[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (text[before] > c)]
        if len(before):
            first = text[before]
            by = np.argsort(first, kind="stable")
            values, at = np.unique(first[by], return_index=True)
            for v, part in zip(values.tolist(), np.split(before[by], at[1:]), strict=True):
                waiting[v].append(part)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[np.append(wanted, [False, False])[order]], words


def common_prefix(order: np.ndarray, words: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of neighbours in ``order``, up to ``most``."""
    a, b = order[:-1], order[1:]
    length = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    for d in range(0, most, 8):
        x = words[a[alive] + d] ^ words[b[alive] + d]
        same = x == 0
        length[alive[same]] = d + 8
        rest, x = alive[~same], x[~same]
        equal = np.zeros(len(x), np.int64)
        for k in range(1, 8):
            equal += x < (U(1) << U(64 - 8 * k))
        length[rest] = d + equal
        alive = alive[same]
    return np.minimum(length, most)
