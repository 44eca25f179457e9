"""Alignment of two tokenizers over the same bytes by galloping intersection.

Both tokenizers read a blank and the text; their tokens cover the same bytes, so
each gives an ascending list of token ends. Entries of the shorter list look for
themselves in the longer one: each starts where its predecessor was found,
doubles its step until it has passed its value, and halves the span that is left
(all entries of a level move together; every second entry is placed first and is
where its follower starts). Common ends cut both token lists into groups, and
differences of their ranks say how many tokens of either side share a group.

Every pair of tokens in one group is a link. How many documents hold an id pair
linked is summed over the corpus: a block of documents sends each of its distinct
pairs once, with its count, and gets the corpus counts of those pairs back. So no
pair has more rows than there are blocks, and nothing is broadcast.

Each side reads whole texts; the merges of the first come from its own file.

Defined cases: a null or empty text has no tokens, nor has a text whose joined
token bytes differ from blank + text on either side (it holds the word mark of
the second tokenizer, for example): zeros and an empty string. Repeated rows
count as documents of their own; a null doc_id stays null; an empty table gives
an empty table; other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stored, table
from .tokens import _byte_letters, file_bytes

#: Rows and characters of a block: its documents are aligned and counted together. A longer text is a block of its own.
ROWS, CHARS = 1_024, 1 << 22
#: Neighbours in the shorter list that start their search from the same place.
LANE = 2
#: Groups with more links are linked by distinct ids.
WIDE = 4_096
_MARK = "▁"


def gallop(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Place in ``among`` of the first entry that is not less than each of ``values``; both
    ascending, and the last of ``values`` is not above the last of ``among``."""
    if len(values) > LANE:
        low = np.repeat(gallop(values[::LANE], among), LANE)[: len(values)]
    else:
        low = np.zeros(len(values), np.int64)
    high, step, last = low.copy(), 1, len(among) - 1
    lanes = np.flatnonzero(among[high] < values)
    while len(lanes):
        low[lanes] = high[lanes] + 1
        high[lanes] = np.minimum(high[lanes] + step, last)
        step *= 2
        lanes = lanes[among[high[lanes]] < values[lanes]]
    lanes = np.flatnonzero(low < high)
    while len(lanes):
        middle = (low[lanes] + high[lanes]) >> 1
        less = among[middle] < values[lanes]
        low[lanes] = np.where(less, middle + 1, low[lanes])
        high[lanes] = np.where(less, high[lanes], middle)
        lanes = lanes[low[lanes] < high[lanes]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks, in both ascending lists, of the ends that they share."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(a) > len(b):
        return common_ends(b, a)[::-1]
    inside = np.searchsorted(a, b[-1], "right")  # beyond the other list nothing is shared
    at = gallop(a[:inside], b)
    hit = np.flatnonzero(b[at] == a[:inside])
    return hit, at[hit]


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a_json: bytes, b_model: bytes):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        letters, model = _byte_letters(), json.loads(a_json)
        special = {t["id"] for t in model["added_tokens"]}  # plain text here: their bytes go through the merges
        vocab = {bytes(letters[c] for c in piece): k for piece, k in model["model"]["vocab"].items() if k not in special}
        merged = [bytes(letters[c] for c in "".join(m.split(" ") if isinstance(m, str) else m)) for m in model["model"]["merges"]]
        # ids of merged tokens rank them here, so they have to follow the order of the merges
        if [vocab[m] for m in merged] != sorted(vocab[m] for m in merged) or len(merged) + 256 != len(vocab):
            raise ValueError("the ids of the first tokenizer do not follow its merges")
        self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=vocab, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_model)  # puts the blank in front itself
        self.a_length = np.zeros(max(vocab.values()) + 1, np.int64)
        self.a_length[list(vocab.values())] = [len(x) for x in vocab]
        pieces = [self._b.id_to_piece(k) for k in range(self._b.get_piece_size())]
        self._shown = [self._bytes(k, piece) for k, piece in enumerate(pieces)]
        self.b_length = np.array([len(x) for x in self._shown], np.int64)
        if max(len(self.a_length), len(pieces)) > 1 << 16:
            raise ValueError("a vocabulary has more than 65,536 ids")

    def _bytes(self, k: int, piece: str) -> bytes:
        if self._b.is_byte(k):
            return bytes([int(piece[3:-1], 16)])
        return b"" if self._b.is_control(k) or self._b.is_unknown(k) else piece.replace(_MARK, " ").encode()

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of blank + text on both sides; None for texts without tokens."""
        some = [t for t in texts if t]
        b = iter(self._b.encode(some, num_threads=1) if some else [])
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text in texts:
            if not text:
                out.append(None)
                continue
            x, y = self._a.encode_ordinary(" " + text), next(b)
            raw = (" " + text).encode("utf-8", "replace")  # all bytes go through the merges on the first side
            same = b"".join([self._shown[k] for k in y]) == raw
            out.append((np.array(x, np.int64), np.array(y, np.int64)) if same else None)
        return out


class Alignment:
    """Groups of a block of documents: ids in a row on both sides, and where groups and documents end."""

    def __init__(self, pair: Pair, texts: list[str | None]):
        self.ids = pair.encode(texts)
        some = [x for x in self.ids if x is not None]
        none = np.zeros(0, np.int64)
        self.a = np.concatenate([x[0] for x in some] or [none])
        self.b = np.concatenate([x[1] for x in some] or [none])
        a_ends, b_ends = np.cumsum(pair.a_length[self.a]), np.cumsum(pair.b_length[self.b])
        at_a, at_b = common_ends(a_ends, b_ends)
        self.ends = a_ends[at_a]  # bytes before the end of each group
        self.a_to, self.b_to = at_a + 1, at_b + 1
        self.a_from, self.b_from = (np.concatenate(([0], x[:-1]))[: len(x)] for x in (self.a_to, self.b_to))
        self.n_a = np.array([0 if x is None else len(x[0]) for x in self.ids], np.int64)
        self.n_b = np.array([0 if x is None else len(x[1]) for x in self.ids], np.int64)
        self.a_end, self.b_end = np.cumsum(self.n_a), np.cumsum(self.n_b)  # by document
        self.group_end = np.searchsorted(self.a_to, self.a_end, "right")
        self.group_start = np.concatenate(([0], self.group_end[:-1]))[: len(self.group_end)]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(document << 32 | a id << 16 | b id) ascending, and how often each is linked."""
        doc = np.repeat(np.arange(len(self.ids)), self.group_end - self.group_start) << 32
        n_a, n_b = self.a_to - self.a_from, self.b_to - self.b_from
        single = (n_a == 1) & (n_b == 1)
        keys = [doc[single] | self.a[self.a_from[single]] << 16 | self.b[self.b_from[single]]]
        some = np.flatnonzero(~single & (n_a * n_b <= WIDE))
        each = (n_a * n_b)[some]
        group = np.repeat(some, each)
        k = np.arange(len(group)) - np.repeat(np.cumsum(each) - each, each)
        keys.append(doc[group] | self.a[self.a_from[group] + k // n_b[group]] << 16 | self.b[self.b_from[group] + k % n_b[group]])
        key, times = np.unique(np.concatenate(keys), return_counts=True)
        wide = [(key, times)]
        for g in np.flatnonzero(n_a * n_b > WIDE).tolist():
            a, in_a = np.unique(self.a[self.a_from[g] : self.a_to[g]], return_counts=True)
            b, in_b = np.unique(self.b[self.b_from[g] : self.b_to[g]], return_counts=True)
            wide.append(((doc[g] | a[:, None] << 16 | b).ravel(), (in_a[:, None] * in_b).ravel()))
        if len(wide) > 1:
            key, where = np.unique(np.concatenate([x[0] for x in wide]), return_inverse=True)
            times = np.zeros(len(key), np.int64)
            np.add.at(times, where, np.concatenate([x[1] for x in wide]))
        return key, times

    def digests(self, shown: list[bytes]) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` of each document; empty without tokens."""
        n_a, n_b = self.a_to - self.a_from, self.b_to - self.b_from
        codes = np.zeros(len(self.a) + len(self.b), np.int64)
        a, b = self.a.copy(), self.b.copy()
        a[self.a_to - 1] += 1 << 16  # ends with a bar
        b[self.b_to - 1] += 2 << 16  # ends with a semicolon
        codes[np.arange(len(a)) + np.repeat(self.b_from, n_a)] = a
        codes[np.arange(len(b)) + np.repeat(self.a_to, n_b)] = b
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            text = b"".join(map(shown.__getitem__, codes[at : at + n].tolist()))
            out.append(hashlib.sha256(text[:-1]).hexdigest() if n else "")
            at += n
        return out


_PAIRS: dict[int, Pair] = {}


def _pair(a: Broadcast, b: Broadcast) -> Pair:
    """Both tokenizers, once per worker process."""
    key = hash((a.value, b.value))
    if key not in _PAIRS:
        _PAIRS[key] = Pair(a.value, b.value)
    return _PAIRS[key]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(doc_ids, texts) of blocks of rows."""
    ids: list = []
    texts: list = []
    size = 0
    for batch in slices(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            n = len(text or "")
            if ids and (len(ids) >= ROWS or size + n > CHARS):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += n
    if ids:
        yield ids, texts


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def groups(docs: DataFrame, a: Broadcast, b: Broadcast) -> DataFrame:
    """The alignment itself, per document: ids of both sides, and per group the tokens before
    its end on either side and the byte of blank + text at which it ends."""
    kinds = [pa.int64(), *[pa.list_(pa.int32())] * 4, pa.list_(pa.int64())]
    names = ["doc_id", "a_ids", "b_ids", "a_to", "b_to", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a, b)
        for ids, texts in _blocks(batches):
            x = Alignment(pair, texts)
            columns: list[list] = [ids, [], [], [], [], []]
            for k in range(len(ids)):
                g, from_a, from_b = slice(x.group_start[k], x.group_end[k]), x.a_end[k] - x.n_a[k], x.b_end[k] - x.n_b[k]
                before = x.ends[x.group_start[k] - 1] if x.group_start[k] else 0
                for column, value in zip(columns[1:], (x.a[from_a : x.a_end[k]], x.b[from_b : x.b_end[k]], x.a_to[g] - from_a,
                                                       x.b_to[g] - from_b, x.ends[g] - before), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    shape = "doc_id long, a_ids array<int>, b_ids array<int>, a_to array<int>, b_to array<int>, ends array<long>"
    return _named(docs).mapInArrow(run, shape)


_BLOCK = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "sha256 array<string>, pairs array<long>, holders array<long>, n_pairs array<long>, pair binary, times binary")


def aligned_blocks(docs: DataFrame, a: Broadcast, b: Broadcast) -> DataFrame:
    """One row per block: figures of its documents, its distinct id pairs (a << 32 | b) with the
    number of its documents that hold them, and the pairs of each document as places in that list."""
    lists = [pa.list_(pa.int64())] * 5
    kinds = [pa.int64(), *lists, pa.list_(pa.string()), *[pa.list_(pa.int64())] * 3, pa.binary(), pa.binary()]
    names = [column.split(" ")[0] for column in _BLOCK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a, b)
        shown = [f"{k}{end}".encode() for end in ",|;" for k in range(1 << 16)]
        for number, (ids, texts) in enumerate(_blocks(batches)):
            x = Alignment(pair, texts)
            key, times = x.links()
            pairs, place, holders = np.unique(key & 0xFFFFFFFF, return_inverse=True, return_counts=True)
            n_pairs = np.bincount(key >> 32, minlength=len(ids))
            per_group = np.concatenate(([0], np.cumsum((x.a_to - x.a_from) * (x.b_to - x.b_from))))
            row = [TaskContext.get().partitionId() << 32 | number, ids, x.n_a, x.n_b, x.group_end - x.group_start,
                   per_group[x.group_end] - per_group[x.group_start], x.digests(shown), (pairs >> 16) << 32 | pairs & 0xFFFF, holders, n_pairs,
                   place.astype("<u4").tobytes(), times.astype("<u4").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds, strict=True)], names)

    return _named(docs).mapInArrow(run, _BLOCK)


def _a_id() -> Column:
    return F.shiftright("pair", 32)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair (a << 32 | b), n_docs that hold it linked, and whether no pair of its a id has more."""
    zipped = F.explode(F.arrays_zip("pairs", "holders")).alias("x")
    counts = blocks.select(zipped).select(F.col("x.pairs").alias("pair"), F.col("x.holders").alias("n")).groupBy("pair").agg(F.sum("n").alias("n_docs"))
    counts = stored(counts, "pair-counts")
    top = counts.groupBy(_a_id().alias("a_id")).agg(F.max("n_docs").alias("most"))
    return counts.join(top, _a_id() == top["a_id"]).select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


_FIGURES = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def figures(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document its figures, its links to best pairs and the sum of its links' counts."""
    at = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    answer = at.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("place", "n_docs", "best")).alias("answer"))
    columns = ["doc_ids", "n_a", "n_b", "n_groups", "n_links", "sha256", "n_pairs", "pair", "times"]
    joined = blocks.select("block", *columns).join(answer, "block", "left").select(*columns, "answer.place", "answer.n_docs", "answer.best")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [column.split(" ")[0] for column in _FIGURES.split(", ")]
        for batch in slices(batches, 1):
            value = {name: batch.column(k)[0] for k, name in enumerate([*columns, "place", "n_docs", "best"])}
            doc_ids, n_a, n_b, n_groups, n_links, sha256 = (value[c].values for c in columns[:6])
            sums = []
            n = value["n_pairs"].values.to_numpy()
            end = np.cumsum(n)
            pair, times = (np.frombuffer(value[c].as_py(), "<u4").astype(np.int64) for c in ("pair", "times"))
            order = np.argsort(value["place"].values.to_numpy()) if value["place"].is_valid else np.zeros(0, np.int64)
            for column in ("best", "n_docs"):
                got = value[column].values.to_numpy(zero_copy_only=False)[order].astype(np.int64) if len(order) else order
                total = np.concatenate(([0], np.cumsum(got[pair] * times)))
                sums.append(pa.array(total[end] - total[end - n]))
            yield pa.RecordBatch.from_arrays([doc_ids, n_a, n_b, n_groups, n_links, *sums, sha256], names)

    return joined.mapInArrow(run, _FIGURES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a = file_bytes(spark, public_tokenizers.path("byte_bpe_50k.json"))
    b = file_bytes(spark, public_tokenizers.path("piece_bpe_32k.model"))
    blocks = stored(aligned_blocks(table(spark, sf_dir, "documents"), a, b), "aligned")
    return figures(blocks, pair_counts(blocks))
