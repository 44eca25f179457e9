"""Word-wise use of a public tokenizer file inside Arrow tasks.

The pieces of this tokenizer never cross ASCII white space, so a text's ids are
its words' ids in a row: a task finds the distinct words of a chunk by 64-bit
hash, encodes those it has not met, and gathers stored ids. Words of printable ASCII and Latin letters go through a merge table in
one call per batch (the end-of-word mark becomes a byte that first joins the
last byte); any other word goes through the tokenizer file itself. Both give the
same ids; the tests compare them.

The file is read on the driver and travels as a broadcast of its bytes (a
vocabulary file of a few MB).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

from . import bytewise as bw

#: Bytes of text whose words are looked up together.
CHUNK = 1 << 20
#: Units kept per worker; beyond it the memo starts anew (results do not change).
MEMO = 500_000
_PLAIN = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
#: Pre-token pattern of the tokenizer file (fixed value).
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_END = "\x00"


def file_bytes(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as fh:
        return spark.sparkContext.broadcast(fh.read())


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable bytes for
    themselves, the others from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class UnitEncoder:
    """Ids of texts as packed little-endian unsigned 32-bit integers, unit by unit.

    A subclass says how a text falls into units and gives the ids of new ones.
    """

    #: Units kept per worker.
    memo = MEMO

    def __init__(self) -> None:
        self._forget()

    def units(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per chunk of texts: joined buffer, start of each text, start and end of each unit."""
        raise NotImplementedError

    def learn(self, units: list[str]) -> list[bytes]:
        """Packed ids of each unit."""
        raise NotImplementedError

    def _forget(self) -> None:
        self._known = np.zeros(0, bw.U)  # hashes of the known units, ascending, and
        self._number = np.zeros(0, np.int64)  # the place of each in start and length
        self._pool = np.zeros(0, "<u4")  # ids of the known units in a row
        self._start = np.zeros(0, np.int64)
        self._length = np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for buf, offsets, starts, ends in self.units(texts):
            hashes, first, each = np.unique(bw.Rolling(buf).of(starts, ends), return_index=True, return_inverse=True)
            unit = self._numbers(hashes, buf, starts[first], ends[first])[each]
            length = self._length[unit]
            before = np.concatenate(([0], np.cumsum(length)))
            ids = self._pool[np.arange(before[-1]) + np.repeat(self._start[unit] - before[:-1], length)].tobytes()
            cuts = (before[np.searchsorted(starts, offsets)] * 4).tolist()
            out += [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def _numbers(self, hashes: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Numbers of the units (ascending hashes); unknown ones are encoded first."""
        if len(self._known) + len(hashes) > self.memo:
            self._forget()
        at = np.searchsorted(self._known, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self._known)
        new[inside] = self._known[at[inside]] != hashes[inside]
        if new.any():
            raw = buf.tobytes()
            ids = self.learn([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            length = np.array([len(x) // 4 for x in ids], np.int64)
            number = len(self._length) + np.arange(len(ids))
            self._start = np.concatenate((self._start, len(self._pool) + np.cumsum(length) - length))
            self._length = np.concatenate((self._length, length))
            self._pool = np.concatenate((self._pool, np.frombuffer(b"".join(ids), "<u4")))
            self._number = np.insert(self._number, at[new], number)
            self._known = np.insert(self._known, at[new], hashes[new])
            at = np.searchsorted(self._known, hashes)
        return self._number[at]


class WordEncoder(UnitEncoder):
    """The word-wise BPE: units are words between ASCII white space."""

    def __init__(self, tokenizer_json: bytes):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_buffer(tokenizer_json)
        super().__init__()
        model = json.loads(tokenizer_json)["model"]
        letters, vocab = _byte_letters(), model["vocab"]

        def raw(piece: str) -> bytes:
            ends = piece.endswith("</w>")
            return bytes(letters[c] for c in piece.removesuffix("</w>")) + _END.encode() * ends

        ranks: dict[bytes, int] = {}
        ids: list[int] = []
        for piece in [*letters, *(c + "</w>" for c in letters)]:
            ranks[raw(piece)] = len(ids)
            ids.append(vocab[piece])
        for left, right in (m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            if raw(left + right) not in ranks:
                ranks[raw(left + right)] = len(ids)
                ids.append(vocab[left + right])
        self._ids = np.array(ids, "<u4")
        self._ends = np.zeros(len(ids), bool)
        self._ends[[k for b, k in ranks.items() if b.endswith(b"\0")]] = True
        self._merge = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self._pretokens = regex.compile(PRETOKENS + r"|\n")

    def units(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        for _, buf, offsets in bw.chunks(texts, CHUNK):
            yield buf, offsets, *bw.words(buf)

    def learn(self, words: list[str]) -> list[bytes]:
        out = [b""] * len(words)
        plain = [bool(_PLAIN.fullmatch(w)) and "<|" not in w for w in words]
        fast = [k for k, p in enumerate(plain) if p]
        for k, ids in zip(fast, self._merged([words[k] for k in fast]), strict=True):
            out[k] = ids
        slow = [k for k, p in enumerate(plain) if not p]
        got = self._tokenizer.encode_batch_fast([words[k] for k in slow], add_special_tokens=False)
        for k, e in zip(slow, got, strict=True):
            out[k] = np.array(e.ids, "<u4").tobytes()
        return out

    def _merged(self, words: list[str]) -> list[bytes]:
        if not words:
            return []
        parts = self._pretokens.findall("\n".join(words).lower() + "\n")
        last = np.flatnonzero(np.array([p == "\n" for p in parts]))  # a break ends each word
        pieces = np.array(self._merge.encode_ordinary(_END.join([p for p in parts if p != "\n"]) + _END))
        part_ends = np.flatnonzero(self._ends[pieces]) + 1  # ids before the end of each pre-token
        cuts = [0, *(part_ends[last - np.arange(len(last)) - 1] * 4).tolist()]
        packed = self._ids[pieces].tobytes()
        return [packed[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_ENCODERS: dict[tuple[type, int], UnitEncoder] = {}


def encoder(kind: type[UnitEncoder], raw: bytes) -> UnitEncoder:
    """One encoder per worker process and tokenizer file, kept between tasks."""
    key = (kind, hash(raw))
    if key not in _ENCODERS:
        _ENCODERS[key] = kind(raw)
    return _ENCODERS[key]
