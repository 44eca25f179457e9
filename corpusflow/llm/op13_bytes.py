"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

**Encoding.** The merges of a rank file are read as a transducer over bytes. Its
nondeterministic form guesses token ends: a hypothesis is (last token, place in
the trie of tokens). A token may end after another only if the merges keep the
two apart, which leaves one complete reading of every string: the merges' own.
Sets of living hypotheses become numbered states when a text first needs them; a
step of the compiled machine gives the next state and the token that ends the
complete reading there. An id leaves as soon as all living hypotheses agree on it
(judged every ``LOOK`` bytes; the lookahead is bounded by the merges, not by the
text), and the end of a unit tells the rest. Units are the matches of the split
pattern; a unit that is a token itself is that token, as in the public library.

**Decoding.** Ids become bytes in blocks. A state machine over the bytes of UTF-8
knows after every block how many bytes of an unfinished character to hold back,
so each block gives whole characters only. Its steps are tabulated per token, and
only stretches that leave the accepting state are walked.

Defined cases: null and empty texts have no ids and decode to nothing; repeated
rows are alike; a null doc_id stays null; an empty table gives an empty table;
other columns of the input, whatever their names, are not read. Ids outside the
file raise; ids that cut a character decode to its bytes, and to the replacement
character in text.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table
from .tokens import encoder, file_bytes

#: Split pattern of the rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Units and determinised states kept per worker; beyond it they start anew (results do not change).
MEMO, STATES = 400_000, 200_000
#: Longer units are not kept; longer texts are split unit by unit instead of at once.
UNIT, TEXT = 64, 1 << 20
#: Bytes of a unit after which agreed ids leave.
LOOK = 256
#: Rank of a merge that does not come.
NEVER = 1 << 62
#: Ids that are decoded at once.
BLOCK = 1 << 16


def rank_file(raw: bytes) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


class Transducer:
    """Ids of units (byte strings) under the ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: raw for raw, rank in ranks.items()}
        self._child: dict[int, int] = {}  # (trie node, byte) -> node
        self._ends, self._depth = [-1], [0]  # token and length of each node
        for raw, rank in ranks.items():
            node = 0
            for byte in raw:
                deeper = self._depth[node] + 1
                node = self._child.setdefault(node << 8 | byte, len(self._ends))
                if node == len(self._ends):
                    self._ends.append(-1)
                    self._depth.append(deeper)
            self._ends[node] = rank
        self._leaf = [True] * len(self._ends)
        for key in self._child:
            self._leaf[key >> 8] = False
        self._spines: dict[int, tuple[list, list] | None] = {}
        self._forget()

    def _forget(self) -> None:
        self._apart: dict[int, bool] = {}
        self._number: dict[tuple[int, ...], int] = {}
        self._state: list[tuple[int, ...]] = []  # hypotheses of each state, (last token + 1) << 20 | trie node
        self._next: dict[int, int] = {}  # (state, byte) -> next state << 20 | token that ends the complete reading
        self._intern((0,))

    def merge(self, raw: bytes, down_to: int = 1) -> list[bytes]:
        """The merges themselves: join the neighbours of least rank, leftmost first."""
        parts, ranks = [raw[k : k + 1] for k in range(len(raw))], self.ranks
        while len(parts) > down_to:
            best, at = None, 0
            for k in range(len(parts) - 1):
                rank = ranks.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: int) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]] | None:
        """Parts of a token at its right and at its left edge while the merges make it, each
        with the rank of the merge that takes it up; None if they do not make the token."""
        if token not in self._spines:
            raw = self.token[token]
            found = ([(raw, NEVER)], [(raw, NEVER)])
            if len(raw) > 1:
                halves = self.merge(raw, 2)
                if len(halves) > 2 or halves[0] + halves[1] not in self.ranks:
                    found = None
                else:
                    left, right = (self._spine(self.ranks[half]) for half in halves)
                    found = ([*right[0][:-1], (right[0][-1][0], token), found[0][0]], [*left[1][:-1], (left[1][-1][0], token), found[1][0]])
            self._spines[token] = found
        return self._spines[token]

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes in a row keep the tokens apart: no part at the
        right edge of one and part at the left edge of the other, there at a time, merge first."""
        key = left << 32 | right
        known = self._apart.get(key)
        if known is None:
            ranks, a, b = self.ranks, self._spine(left)[0], self._spine(right)[1]
            i = j = 0
            known = True
            while True:
                (x, taken_x), (y, taken_y) = a[i], b[j]
                cross = ranks.get(x + y)
                if cross is not None and cross < taken_x and cross <= taken_y:
                    known = False
                    break
                if i == len(a) - 1 and j == len(b) - 1:
                    break
                if taken_x <= taken_y:
                    i += 1
                else:
                    j += 1
            self._apart[key] = known
        return known

    def _intern(self, state: tuple[int, ...]) -> int:
        number = self._number.get(state)
        if number is None:
            number = self._number[state] = len(self._state)
            self._state.append(state)
        return number

    def _step(self, state: int, byte: int) -> int:
        living, complete = [], -1
        for guess in self._state[state]:
            node = self._child.get((guess & 0xFFFFF) << 8 | byte)
            if node is None:
                continue
            if not self._leaf[node]:
                living.append(guess >> 20 << 20 | node)
            token, last = self._ends[node], (guess >> 20) - 1
            if token >= 0 and complete < 0 and self._spine(token) and (last < 0 or self._may_follow(last, token)):
                complete = token
        if complete < 0:
            raise ValueError(f"the ranks have no token for byte {byte}")
        living.append((complete + 1) << 20)
        found = self._next[state << 8 | byte] = self._intern(tuple(living)) << 20 | complete
        return found

    def _agreed(self, state: int, ended: list[int]) -> int:
        """Bytes up to the last token end that all living hypotheses share."""
        ends = {len(ended) - self._depth[guess & 0xFFFFF] for guess in self._state[state]}
        while len(ends) > 1:
            latest = max(ends)
            ends.remove(latest)
            ends.add(latest - len(self.token[ended[latest - 1]]))
        return ends.pop()

    def _told(self, ended: list[int]) -> list[int]:
        """Tokens of the complete reading of all bytes."""
        out, at = [], len(ended)
        while at:
            out.append(ended[at - 1])
            at -= len(self.token[out[-1]])
        return out[::-1]

    def encode(self, raw: bytes) -> bytes:
        """Ids of one unit, packed as little-endian unsigned 32-bit integers."""
        if raw in self.ranks:
            return self.ranks[raw].to_bytes(4, "little")
        out: list[int] = []
        ended: list[int] = []  # token that ends the complete reading at each byte not told yet
        state, steps = 0, self._next
        for byte in raw:
            hit = steps.get(state << 8 | byte)
            if hit is None:
                if len(self._state) >= STATES:
                    here = self._state[state]
                    self._forget()
                    state, steps = self._intern(here), self._next
                hit = self._step(state, byte)
            state = hit >> 20
            ended.append(hit & 0xFFFFF)
            if len(ended) % LOOK == 0 and (agreed := self._agreed(state, ended)):
                out += self._told(ended[:agreed])
                del ended[:agreed]
        out += self._told(ended)
        return struct.pack(f"<{len(out)}I", *out)


def _ranges(characters: set[str]) -> str:
    """The characters as ranges of a pattern's class."""
    codes = sorted(map(ord, characters))
    runs = itertools.groupby(enumerate(codes), lambda x: x[1] - x[0])
    ends = [(run[0][1], run[-1][1]) for run in (list(g) for _, g in runs)]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ends)


@functools.cache
def split_patterns(pattern: str = PATTERN) -> tuple[str, str]:
    """The pattern with its classes as the public library knows them, and a pattern of the
    characters for which that matters: the two regex libraries follow different Unicode
    versions, so both are asked about every character."""
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    differ: set[str] = set()
    for name in (r"\p{L}", r"\p{N}"):
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs = set(bytes(probe.encode_ordinary(every)).decode())
        ours = set(regex.findall(name, every))
        differ |= theirs ^ ours
        exact = f"[{name}{_ranges(theirs - ours)}]"
        if ours - theirs:
            exact = f"[{exact}--[{_ranges(ours - theirs)}]]"
        pattern = pattern.replace(name, exact)
    return pattern, f"[{_ranges(differ)}]" if differ else r"(?!)"


class _Units(dict):
    """Packed ids of units; a missing one is encoded."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self._transducer = transducer

    def __missing__(self, unit: str) -> bytes:
        ids = self._transducer.encode(unit.encode("utf-8", "replace"))
        if len(unit) <= UNIT:
            self[unit] = ids
        return ids


class ByteEncoder:
    """Encoder of texts: split pattern, memo of units, transducer."""

    def __init__(self, ranks: bytes | dict[bytes, int]):
        import regex

        self.transducer = Transducer(rank_file(ranks) if isinstance(ranks, bytes) else ranks)
        self._units = _Units(self.transducer)
        exact, differ = split_patterns()
        self._plain, self._exact, self._differ = regex.compile(PATTERN), regex.compile(exact, regex.V1), re.compile(differ)

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, packed."""
        if not text:
            return b""
        if len(self._units) > MEMO:
            self._units.clear()
        known = self._units.__getitem__
        split = self._exact if self._differ.search(text) else self._plain
        if len(text) <= TEXT:
            return b"".join(map(known, split.findall(text)))
        found = (m.group() for m in split.finditer(text))
        return b"".join(b"".join(map(known, block)) for block in itertools.batched(found, BLOCK))


# --- decoding -----------------------------------------------------------------

#: The state machine of well-formed UTF-8: state -> [(first byte, last byte, next state)].
#: The name of a state is the length of its character and how many of its bytes are read;
#: the letters mark first bytes that narrow the second (fixed values of the Unicode standard).
_RULES: dict[str, list[tuple[int, int, str]]] = {
    "whole": [(0x00, 0x7F, "whole"), (0xC2, 0xDF, "2.1"), (0xE0, 0xE0, "3.1a"), (0xE1, 0xEC, "3.1"), (0xED, 0xED, "3.1b"),
              (0xEE, 0xEF, "3.1"), (0xF0, 0xF0, "4.1a"), (0xF1, 0xF3, "4.1"), (0xF4, 0xF4, "4.1b")],
    "2.1": [(0x80, 0xBF, "whole")],
    "3.1": [(0x80, 0xBF, "3.2")],
    "3.1a": [(0xA0, 0xBF, "3.2")],
    "3.1b": [(0x80, 0x9F, "3.2")],
    "3.2": [(0x80, 0xBF, "whole")],
    "4.1": [(0x80, 0xBF, "4.2")],
    "4.1a": [(0x90, 0xBF, "4.2")],
    "4.1b": [(0x80, 0x8F, "4.2")],
    "4.2": [(0x80, 0xBF, "4.3")],
    "4.3": [(0x80, 0xBF, "whole")],
}
_STATES = list(_RULES)
WHOLE, BROKEN = 0, len(_STATES)
#: Bytes of an unfinished character in each state.
HELD = [0 if s == "whole" else int(s[2]) for s in _STATES]
STEP = np.full((BROKEN + 1, 256), BROKEN, np.uint8)
for _k, _s in enumerate(_STATES):
    for _first, _last, _to in _RULES[_s]:
        STEP[_k, _first : _last + 1] = _STATES.index(_to)


class TokenBytes:
    """Bytes of the tokens of a rank file, and their steps through the state machine."""

    def __init__(self, ranks: bytes | dict[bytes, int]):
        tokens = rank_file(ranks) if isinstance(ranks, bytes) else ranks
        size = max(tokens.values(), default=-1) + 1
        shown = [b""] * size
        for raw, rank in tokens.items():
            shown[rank] = raw
        self.length = np.array([len(x) for x in shown], np.int64)
        self._start = np.cumsum(self.length) - self.length
        self._pool = np.frombuffer(b"".join(shown), np.uint8)
        self.after = np.tile(np.arange(BROKEN + 1, dtype=np.uint8), (size, 1))  # state after a token, by state before
        for at in range(int(self.length.max(initial=0))):
            some = np.flatnonzero(self.length > at)
            self.after[some] = STEP[self.after[some], self._pool[self._start[some] + at][:, None]]

    def raw(self, ids: np.ndarray) -> bytes:
        """Joined bytes of ids."""
        length = self.length[ids]
        if (length == 0).any():
            raise ValueError("an id is not in the rank file")
        before = np.cumsum(length) - length
        return self._pool[np.arange(length.sum()) + np.repeat(self._start[ids] - before, length)].tobytes()


class StreamDecoder:
    """Bytes of a stream of ids, block by block, each block ending with a whole character."""

    def __init__(self, tokens: TokenBytes):
        self._tokens, self._held, self._state = tokens, b"", WHOLE

    def _run(self, raw: bytes, state: int) -> int:
        """State after bytes; a byte that breaks a character begins anew."""
        for byte in raw:
            nxt = int(STEP[state, byte])
            if nxt == BROKEN:
                nxt = int(STEP[WHOLE, byte])
            state = WHOLE if nxt == BROKEN else nxt
        return state

    def feed(self, ids: np.ndarray) -> bytes:
        raw = self._tokens.raw(ids)
        after, state, at = self._tokens.after[ids], self._state, 0
        leaving = np.flatnonzero(after[:, WHOLE] != WHOLE)
        while True:
            if state == WHOLE:  # nothing happens up to the next token that leaves the accepting state
                k = np.searchsorted(leaving, at)
                if k == len(leaving):
                    break
                at = int(leaving[k])
            if at == len(ids):
                break
            nxt = int(after[at, state])
            state = self._run(self._tokens.raw(ids[at : at + 1]), state) if nxt == BROKEN else nxt
            at += 1
        whole = self._held + raw
        cut = len(whole) - HELD[state]
        self._held, self._state = whole[cut:], state
        return whole[:cut]

    def finish(self) -> bytes:
        """What is left of a character that never ended."""
        left, self._held, self._state = self._held, b"", WHOLE
        return left


def blocks(tokens: TokenBytes, packed: bytes | None) -> Iterator[bytes]:
    """Decoded bytes of packed ids, in blocks of whole characters."""
    stream, ids = StreamDecoder(tokens), np.frombuffer(packed or b"", "<u4").astype(np.int64)
    for at in range(0, len(ids), BLOCK):
        yield stream.feed(ids[at : at + BLOCK])
    yield stream.finish()


def decode_text(parts: Iterable[bytes]) -> str:
    """Text of blocks as ``blocks`` gives them."""
    return "".join(part.decode("utf-8", "replace") for part in parts)


# --- tables -------------------------------------------------------------------


def encode(docs: DataFrame, ranks: Broadcast) -> DataFrame:
    """doc_id and ``ids`` (packed little-endian unsigned 32-bit) of every row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ByteEncoder, ranks.value)
        for batch in slices(batches):
            ids = pa.array([enc.encode(text) for text in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks: Broadcast, text: bool = True) -> DataFrame:
    """Add ``decoded`` to (doc_id, ids): the text, or its bytes with ``text=False``."""
    kind = pa.string() if text else pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(TokenBytes, ranks.value)
        for batch in slices(batches):
            parts = (blocks(tokens, x) for x in batch.column(1).to_pylist())
            out = pa.array([decode_text(p) if text else b"".join(p) for p in parts], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, out], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id long, ids binary, decoded {'string' if text else 'binary'}")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = file_bytes(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    found = decode(encode(table(spark, sf_dir, "documents"), ranks), ranks, text=False)
    return found.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
