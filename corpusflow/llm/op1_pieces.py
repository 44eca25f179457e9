"""SentencePiece encoding and decoding with a shared-prefix forward pass.

A text (blanks marked, one mark in front) falls into units that no piece crosses:
blanks with the word after them, and white space that the vocabulary joins to
nothing. A task sorts the distinct new units, which is a depth-first walk of
their trie, and keeps one forward state per depth, so units with a common
prefix share its states. The state of a prefix is the last piece of its best
path; a piece may follow another only if the model keeps the two apart (no parts
at their edges would have merged first), which leaves exactly one path: the
model's own segmentation. (A sum of piece scores would not give this model's ids,
for it ranks merges and not segmentations.)

Defined cases: null and empty texts have no ids and decode to an empty text;
characters without a piece become byte pieces; repeated rows are alike; an empty
table gives an empty table; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytewise as bw
from .common import slices, table
from .tokens import CHUNK, UnitEncoder, encoder, file_bytes

MARK = "▁"
#: Piece pairs remembered per worker; beyond it the memo starts anew.
PAIRS = 400_000
#: Lengths of pieces that any end may have.
SHORT = (2, 1)
#: Code of the first character without a piece; ids of pieces lie below.
OTHER = 1 << 17


class PieceEncoder(UnitEncoder):
    """Encoder and decoder of one model file."""

    memo = 350_000

    def __init__(self, model: bytes):
        import sentencepiece

        super().__init__()
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self._id: dict[str, int] = {}
        self._score: dict[str, float] = {}
        self._byte = [0] * 256
        shown: list[bytes] = []
        for k in range(n):
            piece = sp.id_to_piece(k)
            if sp.is_byte(k):
                self._byte[int(piece[3:-1], 16)] = k
                shown.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k):
                shown.append(b"")
            else:
                self._id[piece], self._score[piece] = k, sp.get_score(k)
                shown.append(piece.replace(MARK, " ").encode())
        lengths: dict[str, set[int]] = {}
        for piece in self._id:
            if len(piece) > 2:
                lengths.setdefault(piece[-3:], set()).add(len(piece))
        self._tails = {tail: (*sorted(found, reverse=True), *SHORT) for tail, found in lengths.items()}  # lengths of pieces by their end
        self._pieces = [sp.id_to_piece(k) for k in range(n)]
        self._apart: dict[int, bool] = {}  # by both codes
        self._made: set[int] = set()  # codes of pieces that the rule makes
        self._spines: dict[str, tuple[list, list] | None] = {}
        # units are cut where no piece goes across
        inner = {p[k : k + 2] for p in self._id for k in range(len(p) - 1)}
        if any(x[0] != MARK and x[1] == MARK for x in inner):
            raise ValueError("a piece joins a blank to what is before it")
        self._before, self._after = np.zeros(256, bool), np.zeros(256, bool)
        for code in (9, 10, 11, 12, 13):
            self._before[code] = not any(x[1] == chr(code) for x in inner)
            self._after[code] = not any(x[0] == chr(code) for x in inner)
        self._packed = [self._bytes(k) for k in range(n)]
        self._shown_length = np.array([len(x) for x in shown], np.int64)
        self._shown_start = np.cumsum(self._shown_length) - self._shown_length
        self._shown = np.frombuffer(b"".join(shown), np.uint8)

    def units(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Units: blanks with the word after them; other white space alone where no piece joins it
        to a neighbour. A text that holds the mark itself is one unit."""
        marked = [" " + t if t else "" for t in texts]
        for part, buf, offsets in bw.chunks(marked, CHUNK):
            blank = buf == 32
            head = self._before[buf]
            head[0] = True
            head[1:] |= (blank[1:] & ~blank[:-1]) | self._after[buf[:-1]]
            head[offsets[:-1]] = head[offsets[1:] - 1] = True  # texts, and the breaks after them
            for k, raw in enumerate(part):
                if MARK.encode() in raw:
                    head[offsets[k] + 1 : offsets[k + 1] - 1] = False
            starts = np.flatnonzero(head)
            ends = np.append(starts[1:], len(buf))
            inner = ~np.isin(starts, offsets[1:] - 1)  # not the break after a text
            yield buf, offsets, starts[inner], ends[inner]

    def merge(self, text: str, down_to: int = 1) -> list[str]:
        """The model's rule itself: join the neighbours whose union ranks best, leftmost first."""
        parts = list(text)
        while len(parts) > down_to:
            best = max(((self._score[u], -k) for k in range(len(parts) - 1) if (u := parts[k] + parts[k + 1]) in self._score), default=None)
            if best is None:
                break
            k = -best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _spine(self, piece: str) -> tuple[list[tuple[str, float]], list[tuple[str, float]]] | None:
        """Parts of a piece at its right and at its left edge while the rule makes it, each with the
        score of the piece that takes it up; None if the rule does not make the piece."""
        if piece not in self._spines:
            found = ([(piece, -math.inf)], [(piece, -math.inf)])
            if len(piece) > 1:
                halves = self.merge(piece, 2)
                sides = [self._spine(half) for half in halves] if len(halves) == 2 and piece in self._score else [None]
                if None in sides:
                    found = None
                else:
                    score = self._score[piece]
                    found = ([*sides[1][0][:-1], (halves[1], score), found[0][0]], [*sides[0][1][:-1], (halves[0], score), found[1][0]])
            self._spines[piece] = found
        return self._spines[piece]

    def _text(self, code: int) -> str:
        """A piece by its code: its id, or ``OTHER`` and the place of a character without a piece."""
        return self._pieces[code] if code < OTHER else chr(code - OTHER)

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the rule keeps two pieces in a row apart: no part at the right edge of one and part
        at the left edge of the other, there at a time, join before either is taken up."""
        if len(self._apart) > PAIRS:
            self._apart.clear()
        score, a, b = self._score, self._spine(self._text(left))[0], self._spine(self._text(right))[1]
        i = j = 0
        known = True
        while True:
            (x, taken_x), (y, taken_y) = a[i], b[j]
            cross = score.get(x + y)
            if cross is not None and cross > taken_x and cross >= taken_y:
                known = False
                break
            if i == len(a) - 1 and j == len(b) - 1:
                break
            if taken_x >= taken_y:
                i += 1
            else:
                j += 1
        self._apart[left << 21 | right] = known
        return known

    def _bytes(self, code: int) -> bytes:
        ids = [code] if code < OTHER else [self._byte[b] for b in self._text(code).encode("utf-8", "replace")]
        return np.array(ids, "<u4").tobytes()

    def learn(self, units: list[str]) -> list[bytes]:
        words = [u.replace(" ", MARK) for u in units]
        out = [b""] * len(words)
        before, last = "", [0]  # last[d]: code of the last piece of the best path to depth d
        start_of = [0]  # and where that piece starts
        ids, apart, whole, tails, packed = self._id, self._apart, self._made, self._tails, self._packed
        for k in sorted(range(len(words)), key=words.__getitem__):
            word = words[k]
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], start_of[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for length in tails.get(word[end - 3 : end], SHORT) if end > 2 else SHORT:
                    start = end - length
                    if start < 0:
                        continue
                    piece = word[start:end]
                    code = ids.get(piece)
                    if code is None:
                        if length > 1:
                            continue
                        code = OTHER + ord(piece)
                    elif code not in whole:
                        if self._spine(piece) is None:
                            continue
                        whole.add(code)
                    if start:
                        known = apart.get(last[start] << 21 | code)
                        if not (self._may_follow(last[start], code) if known is None else known):
                            continue
                    last.append(code)
                    start_of.append(start)
                    break
            path, at = [], len(word)
            while at:
                code = last[at]
                path.append(packed[code] if code < OTHER else self._bytes(code))
                at = start_of[at]
            path.reverse()
            out[k] = b"".join(path)
            before = word
        return out

    def decode(self, packed: list[bytes | None]) -> list[str]:
        """Texts of packed ids; the blank in front that encoding added goes."""
        out = []
        for raw in packed:
            ids = np.frombuffer(raw or b"", "<u4").astype(np.int64)
            length = self._shown_length[ids]
            before = np.cumsum(length) - length
            text = self._shown[np.arange(length.sum()) + np.repeat(self._shown_start[ids] - before, length)].tobytes()
            out.append(text.decode("utf-8", "replace").removeprefix(" "))
        return out


def encode(docs: DataFrame, model: Broadcast) -> DataFrame:
    """doc_id, text and ``ids`` (packed little-endian unsigned 32-bit) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(PieceEncoder, model.value)
        for whole in batches:
            for batch in slices([whole]):
                ids = pa.array(enc.encode(batch.column(1).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], ["doc_id", "text", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, text string, ids binary")


def decode(encoded: DataFrame, model: Broadcast) -> DataFrame:
    """Add ``decoded``, the text of ``ids``, to (doc_id, text, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(PieceEncoder, model.value)
        for whole in batches:
            for batch in slices([whole]):
                text = pa.array(enc.decode(batch.column(2).to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, text], ["doc_id", "text", "ids", "decoded"])

    shape = "doc_id long, text string, ids binary, decoded string"
    return encoded.select("doc_id", "text", "ids").mapInArrow(run, shape)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = file_bytes(spark, public_tokenizers.path("piece_bpe_32k.model"))
    found = decode(encode(table(spark, sf_dir, "documents"), model), model)
    text = F.coalesce("text", F.lit(""))
    return found.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
                        (F.col("decoded") == F.translate(text, MARK, " ")).alias("round_trip"))
