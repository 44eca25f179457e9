"""Hierarchical residual packing of token sequences.

Documents become pieces of at most ``capacity`` ids. Each round deals the open
items into groups of bounded size, packs every group best-fit in falling length,
emits the nearly full bins, and passes the underfull bins on as single items to
a round with fewer groups (a tree merge), until a round no longer saves a bin.

Defined cases: a null or empty text holds the end id only (one piece of length
1); repeated rows are packed each on its own; an empty table packs to nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .tokens import WordEncoder, encoder, file_bytes

CAPACITY = 2048
#: Items that one task packs, about; more items make more groups.
GROUP = 32_768
#: A bin with no more free places than this is nearly full and is emitted.
SLACK = 16
END = b"\0\0\0\0"
#: Texts encoded before their pieces leave the task.
ROWS = 2_000


def pieces(docs: DataFrame, tokenizer: Broadcast, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of each row of ``docs`` (doc_id, text): doc_id, piece, start, length
    and ``ids`` (packed little-endian unsigned 32-bit)."""
    names = ["doc_id", "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(WordEncoder, tokenizer.value)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids = [x + END for x in enc.encode(batch.column(1).to_pylist())]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                parts = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                cut = [ids[r][4 * s : 4 * (s + k)] for r, s, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start),
                                                  pa.array(length), pa.array(cut, pa.binary())], names)

    shape = "doc_id long, piece int, start long, length long, ids binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, shape)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best fit in the given order: bin and offset of each item, and fill of each bin.

    Bins are kept by free room; a bit set of the rooms in use finds the tightest.
    """
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    used_rooms = 0
    bins, offsets, fill = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    for i, n in enumerate(lengths.tolist()):
        open_rooms = used_rooms >> n
        if open_rooms:
            room = n + (open_rooms & -open_rooms).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                used_rooms ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        left = room - n
        if left:
            rooms[left].append(b)
            used_rooms |= 1 << left
    return bins, offsets, fill


def _pack_round(items: DataFrame, level: int, groups: int, capacity: int) -> DataFrame:
    """Assign items (item, length) to bins: item, bin, place, fill."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        item, length = group.column("item").to_numpy(), group.column("length").to_numpy()
        order = np.lexsort((item, -length))
        bins, places, fill = best_fit(length[order], capacity)
        names = (level << 58) + (key[0].as_py() << 20) + bins
        return pa.table({"item": item[order], "bin": names, "place": places, "fill": np.array(fill, np.int64)[bins]})

    dealt = items.withColumn("_group", F.pmod(F.xxhash64("item"), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(run, "item long, bin long, place long, fill long")


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP, slack: int = SLACK) -> DataFrame:
    """Pack stored items (item: unique long, length) into sequences: item, sequence_id, offset."""
    rounds: list[DataFrame] = []
    todo, n = items.select("item", "length"), items.count()
    while n:
        groups = -(-n // group)
        rounds.append(found := stored(_pack_round(todo, len(rounds), groups, capacity), "packed"))
        todo = found.groupBy("bin").agg(F.first("fill").alias("length"))
        bins = todo.count()
        todo = todo.where(F.col("length") < capacity - slack).withColumnRenamed("bin", "item")
        open_bins = todo.count()
        if groups == 1 or bins == n:  # all met in one group, or nothing could be merged
            break
        n = open_bins
    if not rounds:
        return items.select("item", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def follow(at: DataFrame, step: DataFrame) -> DataFrame:
        up = step.select(F.col("item").alias("sequence_id"), "bin", "place")
        joined = at.join(up, "sequence_id", "left")
        return joined.select("item", F.coalesce("bin", "sequence_id").alias("sequence_id"),
                             (F.col("offset") + F.coalesce("place", F.lit(0))).alias("offset"))

    first = rounds[0].select("item", F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
    return reduce(follow, rounds[1:], first)


def packed_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length,
    ids_crc32 (and ``ids``), sequence_id, offset."""
    made = pieces(docs, file_bytes(docs.sparkSession, tokenizer_path), capacity).withColumn("ids_crc32", F.crc32("ids"))
    cut = stored((made if with_ids else made.drop("ids")).withColumn("item", F.monotonically_increasing_id()), "pieces")
    return cut.join(pack(cut, capacity), "item").drop("item")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
