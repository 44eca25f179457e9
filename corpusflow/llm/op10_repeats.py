"""Repeated byte strings by suffix arrays, over partitions of shared seeds.

A byte goes if a ``LENGTH``-byte string that covers it also starts earlier. Equal
strings contain the same minimal seed, so strings meet by seed:

1. Tasks cut each text into runs of string starts with a common seed; a run's
   span is the bytes its strings cover. Seeds that occur once are done.
2. Of runs with equal span (by 128 bits, with the seed) all but the first repeat
   as a whole.
3. First runs whose seed has other spans too go, bytes and all, to suffix arrays:
   seeds are dealt into blocks of bounded size, each block is sorted in two
   stages, and neighbours whose common prefix reaches ``LENGTH`` are equal
   strings. Seeds with very many spans deal their strings by the strings' own
   hash instead, so no block grows with one hot passage.
4. Texts are joined with their repeated runs.

Exact copies of a text repeat as a whole and leave before step 1.

Defined cases: null and empty texts have no bytes; a text shorter than
``LENGTH`` stays; rows that repeat doc_id and text count as one; different texts of
one doc_id are told apart by ``sub``, a hash of the text (0 if the doc_id has one
text), in whose order they come; a null doc_id comes before all others; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bytewise as bw
from .common import broadcast_checked, release, stored, table, with_group_min
from .suffixes import common_prefix, suffix_order

LENGTH, SEED = 100, 32
WINDOW = LENGTH - SEED + 1  # seeds in a string
BLOCK = 1 << 22  # string starts handled at once; a longer text goes in parts
#: Spans per suffix array block, about, and the most spans of one seed in it.
SPANS, HOT = 16_000, 4_000
NO_ID = -(1 << 63)


def runs(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per part of a text: seed, span hash, first string start and number of starts."""
    buf = np.frombuffer(raw, np.uint8)
    starts = len(buf) - LENGTH + 1
    for at in range(0, max(starts, 0), BLOCK):
        n = min(BLOCK, starts - at)
        roll = bw.Rolling(buf[at : at + n + LENGTH - 1])
        places = np.arange(n + WINDOW - 1)
        seeds = roll.of(places, places + SEED)
        low = bw.U((1 << 24) - 1)
        key = (seeds & ~low) | places.astype(bw.U)
        width = 1
        while 2 * width <= WINDOW:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        rest = WINDOW - width
        key = np.minimum(key[: len(key) - rest], key[rest:]) if rest else key
        place = (key & low).astype(np.int64)
        head = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        count = np.diff(np.append(head, n))
        seed_at = place[head]
        shape = ((seed_at - head) * 128 + count).astype(bw.U)
        span = roll.of(head, head + count + LENGTH - 1) ^ bw.mix(shape)
        yield seeds[seed_at], span, head + at, count


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def seed_runs(docs: DataFrame) -> DataFrame:
    """doc, sub, seed, span, packed place (start * 128 + count) and ``known`` of every run.

    A run whose seed and span occurred before in its text is known to repeat; it
    gets a seed of its own, so periodic texts do not pile up on one seed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            size = 0
            for doc, sub, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for seed, span, start, count in runs((text or "").encode("utf-8", "replace")):
                    place = start * 128 + count
                    name = bw.mix(seed * bw.U(3) + span)
                    known = np.ones(len(seed), bool)
                    known[np.unique(name, return_index=True)[1]] = False
                    own = bw.mix(place.astype(bw.U) ^ bw.mix(np.full(1, doc ^ sub, np.int64).view(bw.U)))
                    parts.append((np.full(len(seed), doc, np.int64), np.full(len(seed), sub, np.int64), np.where(known, own, seed), span, place, known))
                    size += len(seed)
                if size > 200_000:
                    yield _batch(parts)
                    parts, size = [], 0
            if parts:
                yield _batch(parts)

    def _batch(parts: list[tuple]) -> pa.RecordBatch:
        doc, sub, seed, span, place, known = (np.concatenate([p[k] for p in parts]) for k in range(6))
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(sub), _signed(seed), _signed(span), pa.array(place), pa.array(known)], ["doc", "sub", "seed", "span", "place", "known"])

    return docs.mapInArrow(run, "doc long, sub long, seed long, span long, place long, known boolean")


def _merged(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive starts of a document as runs: doc, start, count."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    head = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1))) if len(doc) else np.zeros(0, np.int64)
    return doc[head], start[head], np.diff(np.append(head, len(doc)))


def repeated_starts(text: list[bytes], doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of the strings of these spans that also start earlier among them."""
    joined = np.frombuffer(b"".join(text), np.uint8)
    base = np.cumsum([0] + [len(x) for x in text[:-1]])
    each = np.repeat(np.arange(len(text)), count)
    step = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
    wanted = np.zeros(len(joined), bool)
    wanted[base[each] + step] = True
    number = np.zeros(len(joined), np.int64)
    number[base[each] + step] = np.arange(len(each))
    order, words = suffix_order(joined, wanted, LENGTH)
    group = np.cumsum(np.append(0, common_prefix(order, words, LENGTH) < LENGTH))
    k = number[order]
    d, s = doc[each[k]], start[each[k]] + step[k]
    by = np.lexsort((s, d, group))
    group, d, s = group[by], d[by], s[by]
    new = np.append(True, group[1:] != group[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))
    later = (d != d[first]) | (s != s[first])
    return d[later], s[later]


RUN = "doc long, sub long, start long, count long"


def _suffix_block(key: tuple[pa.Scalar, ...], spans: pa.Table) -> pa.Table:
    """Repeated runs of one block of seeds."""
    doc, sub, place = (spans.column(k).to_numpy() for k in ("doc", "sub", "place"))
    order = np.lexsort((sub, doc))
    doc_of, sub_of = doc[order], sub[order]
    item = np.empty(len(doc), np.int64)  # texts numbered in their order
    item[order] = np.maximum.accumulate(np.where(np.append(True, (doc_of[1:] != doc_of[:-1]) | (sub_of[1:] != sub_of[:-1])), np.arange(len(doc)), 0))
    t, s, c = _merged(*repeated_starts(spans.column("bytes").to_pylist(), item, place >> 7, place & 127))
    return pa.table({"doc": doc_of[t], "sub": sub_of[t], "start": s, "count": c})


def _span_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """seed, doc, sub, place and bytes of the wanted runs (doc, sub, seed, place)."""
    listed = wanted.groupBy("doc", "sub").agg(F.collect_list(F.struct("seed", "place")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, sub, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = (text or "").encode("utf-8", "replace")
                place = [r["place"] for r in found]
                cut = [raw[p >> 7 : (p >> 7) + (p & 127) + LENGTH - 1] for p in place]
                columns = [pa.array([r["seed"] for r in found], pa.int64()), pa.array([doc] * len(place), pa.int64()), pa.array([sub] * len(place), pa.int64()),
                           pa.array(place, pa.int64()), pa.array(cut, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["seed", "doc", "sub", "place", "bytes"])

    return docs.join(listed, ["doc", "sub"]).select("doc", "sub", "text", "runs").mapInArrow(run, "seed long, doc long, sub long, place long, bytes binary")


def _hot_strings(spans: DataFrame) -> DataFrame:
    """Repeated runs among hot seeds: strings dealt by their own 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, sub, place, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                buf = np.frombuffer(raw, np.uint8)
                at = np.arange(place & 127)
                a, b = bw.Rolling(buf).of(at, at + LENGTH), bw.Rolling(buf, bw.FOLDED_CODE[::-1]).of(at, at + LENGTH)
                yield pa.RecordBatch.from_arrays([_signed(a), _signed(b), pa.array(np.full(len(at), doc, np.int64)), pa.array(np.full(len(at), sub, np.int64)), pa.array(at + (place >> 7))], ["a", "b", "doc", "sub", "start"])

    strings = spans.select("doc", "sub", "place", "bytes").mapInArrow(run, "a long, b long, doc long, sub long, start long")
    dealt = strings.withColumn("salt", F.pmod(F.xxhash64("doc", "sub"), F.lit(64)).cast("int"))
    least = dealt.groupBy("a", "b", "salt").agg(F.min(F.struct("doc", "sub", "start")).alias("one"), F.count("*").alias("n"))
    shared = least.groupBy("a", "b").agg(F.min("one").alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n")
    first = least.select("a", "b", "salt").join(shared, ["a", "b"])
    found = dealt.join(first, ["a", "b", "salt"]).where("doc <> first.doc or sub <> first.sub or start <> first.start")
    return found.select("doc", "sub", "start", F.lit(1).cast("long").alias("count"))


def repeated_runs(docs: DataFrame) -> DataFrame:
    """Runs (doc, sub, start, count) of string starts that repeat, over distinct texts (doc, sub, text)."""
    by_seed, by_span = Window.partitionBy("seed").orderBy("span", "doc", "sub", "place"), Window.partitionBy("seed", "span").orderBy("doc", "sub", "place")
    ranked = seed_runs(docs).select(
        "*", F.row_number().over(by_span).alias("nth"), F.lag("span").over(by_seed).alias("before"), F.lead("span").over(by_seed).alias("after"))
    met = ranked.where("known or before is not null or after is not null")
    met = stored(met.select("doc", "sub", "place", F.when(~F.col("known") & (F.col("nth") == 1), F.col("seed")).alias("seed")), "seed_runs")
    release(docs.sparkSession)
    start, count = F.shiftright("place", 7), F.col("place").bitwiseAND(F.lit(127))
    whole = met.where("seed is null").select("doc", "sub", start.alias("start"), count.alias("count"))
    firsts = met.where("seed is not null")
    sizes = firsts.groupBy("seed").agg(F.count("*").alias("spans")).where("spans > 1")
    spans = stored(_span_bytes(docs, firsts.join(sizes.select("seed"), "seed")).join(sizes, "seed"), "spans")
    release(docs.sparkSession)
    cool = spans.where(F.col("spans") <= HOT)
    blocks = max(1, -(-cool.count() // SPANS))
    sorted_ = cool.withColumn("_block", F.pmod(F.xxhash64("seed"), F.lit(blocks))).groupBy("_block").applyInArrow(_suffix_block, RUN)
    return whole.unionByName(sorted_).unionByName(_hot_strings(spans.where(F.col("spans") > HOT)))


def _cut(raw: bytes, found: list[dict] | None) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs and the remaining bytes."""
    if not found:
        return 0, 0, raw
    starts = np.array([r["start"] for r in found])
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + np.array([r["count"] for r in found]) + LENGTH - 1, len(raw)), -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs_ = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), runs_, np.frombuffer(raw, np.uint8)[~gone].tobytes()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``kept`` (remaining bytes) per row."""
    named = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text")
    hashed = named.where(F.octet_length("text") >= LENGTH).select("doc", F.xxhash64("text").alias("hash"), F.md5("text").alias("md5"))
    texts = stored(hashed.groupBy("doc", "hash", "md5").agg(F.count("*").alias("rows")), "texts")
    several = stored(texts.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc", F.lit(True).alias("several")), "several")

    def told_apart(df: DataFrame) -> DataFrame:
        joined = df.join(broadcast_checked(several), "doc", "left")
        return joined.withColumn("sub", F.when(F.col("several"), F.col("hash")).otherwise(F.lit(0))).drop("several", "hash")

    named = told_apart(named.withColumn("hash", F.xxhash64("text")))
    first = told_apart(with_group_min(texts.withColumn("place", F.struct("doc", "hash")), "md5", "place", "first"))
    copies = stored(first.where("place <> first").select("doc", "sub").distinct(), "copies")
    twice = stored(told_apart(texts.where("rows > 1")).select("doc", "sub"), "twice")
    alone = named.join(broadcast_checked(copies), ["doc", "sub"], "left_anti").select("doc", "sub", "text").where(F.octet_length("text") >= LENGTH)
    if n_twice := twice.count():
        again = F.broadcast(twice) if n_twice <= 500_000 else twice
        once = alone.join(again, ["doc", "sub"], "left_anti")
        alone = once.unionByName(alone.join(again, ["doc", "sub"], "left_semi").dropDuplicates(["doc", "sub"]))
    found = repeated_runs(alone).groupBy("doc", "sub").agg(F.collect_list(F.struct("start", "count")).alias("runs"))
    lists = stored(found.withColumn("copy", F.lit(False)).unionByName(copies.withColumns({"runs": F.lit(None).cast("array<struct<start:long,count:long>>"), "copy": F.lit(True)})), "repeats")
    release(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found, copy in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                raw = (text or "").encode("utf-8", "replace")
                if copy and len(raw) >= LENGTH:
                    rows.append((len(raw), len(raw), 1, b""))
                else:
                    rows.append((len(raw), *_cut(raw, found if len(raw) >= LENGTH else None)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = named.join(lists, ["doc", "sub"], "left").select("doc_id", "text", "runs", "copy")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
