"""Hard negatives by best-first search over STR-packed R-trees.

Rows are dealt into shards along their label and their widest coordinate, equal
values by a hash of their id, so a vector that a third of all rows share fills
many shards. Each shard is packed by sort-tile-recursive: its rows are sorted by
their widest coordinate into slabs, each slab by its own, down to leaves of
``LEAF`` rows; boxes over leaves, and boxes over boxes, keep the least and the
greatest value of every coordinate, the range of labels and the least id.

For an anchor, every coordinate of a box gives an interval of products, and their
sums bound the scores below. Boxes outside a score window or without a fitting
label are not looked into; a queue takes the leaves that are left by their best
possible score (ties: least id), and the search ends when the best leaf left is
below the last row kept.
The anchors meet the shards in blocks, which follow each shard into its task, without
a join or a broadcast: each shard gives the first rows of each anchor, and the first
of those over all shards stand.

Scores are integer inner products; higher scores come first, ties by smaller id.

Defined cases: rows with a null id, label or vector, or with a null or non-finite
component, take no part. A shorter vector counts as followed by zeros; an empty
one is all zeros. Of anchors that share an id, the one with the least label, then
vector, stands; other repeated rows are candidates of their own, and an anchor's
other rows are those with another id. An anchor without rows of its label has no
positives and gives no rows; an empty table gives an empty table. Components
beyond 31 bits after scaling, and scores beyond 62, raise an error. Other columns
of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

#: Rows of a shard and anchors of a block, about; rows of a leaf; boxes under a box.
SHARD, BLOCK, LEAF, FAN = 8_192, 1_024, 64, 8
SCALE = 256
_ROWS = "vec_id long, label long, vector array<int>"


def scaled(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and ``vector``: floor(scale * x) of each component of ``embedding``; rows that take no part are gone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            valid = pc.and_(pc.and_(pc.is_valid(batch.column(0)), pc.is_valid(batch.column(1))), pc.is_valid(lists))
            batch = batch.filter(valid)
            lists = batch.column(2)
            values = lists.flatten()
            x = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(x) | values.is_null().to_numpy(zero_copy_only=False))))
            length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            end = np.cumsum(length)
            good = bad[end] == bad[end - length]
            each = np.repeat(good, length)
            if (np.abs(x[each]) >= 1 << 31).any():
                raise ValueError("a component does not fit 31 bits after scaling")
            offsets = np.concatenate(([0], np.cumsum(length[good]))).astype(np.int32)
            vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(x[each].astype(np.int32)))
            keep = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([keep.column(0), keep.column(1), vectors], ["vec_id", "label", "vector"])

    columns = F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    return rows.select(*columns).mapInArrow(run, _ROWS)


def widest(rows: DataFrame) -> int:
    """Coordinate with the greatest variance (0 for an empty table); sums per batch, added by coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            length = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
            at = np.arange(len(values)) - np.repeat(np.cumsum(length) - length, length)
            sums = [np.bincount(at, w) if len(at) else np.zeros(0) for w in (None, values, values * values)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums[0]))), *(pa.array(s.astype(np.float64)) for s in sums)], ["at", "n", "s", "ss"])

    parts = rows.select("vector").mapInArrow(run, "at long, n double, s double, ss double").groupBy("at")
    spread = parts.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    top = spread.orderBy((F.col("ss") - F.col("s") * F.col("s") / F.col("n")).desc(), "at").first()
    return top["at"] if top else 0


def _matrix(lists: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(lists), max(map(len, lists), default=0)), np.int64)
    for k, x in enumerate(lists):
        out[k, : len(x)] = x
    return out


def tiles(vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, list[int]]:
    """Sort-tile-recursive order of the rows, and where its leaves start (and the last ends)."""
    order: list[np.ndarray] = []
    starts, size = [], 0
    todo = [np.lexsort((ids,))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            starts.append(size)
            order.append(rows)
            size += len(rows)
            continue
        x = vectors[rows]
        spread = x.max(0) - x.min(0) if x.shape[1] else np.zeros(1)
        leaves = -(-len(rows) // leaf)
        levels = max(1, min(x.shape[1], leaves.bit_length() - 1))
        slabs = max(2, round(leaves ** (1 / levels)))
        if spread.max() > 0:
            rows = rows[np.lexsort((ids[rows], x[:, spread.argmax()]))]
        step = -(-leaves // slabs) * leaf
        todo += [rows[at : at + step] for at in range(0, len(rows), step)][::-1]
    return np.concatenate(order) if order else np.zeros(0, np.int64), [*starts, size]


class Tree:
    """Boxes over the rows of a shard, packed bottom up; leaves come first, the root last."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        by_label = np.argsort(labels, kind="stable")
        order, self.start = [], [0]
        for run in np.split(by_label, np.flatnonzero(np.diff(labels[by_label])) + 1):
            places, starts = tiles(vectors[run], ids[run])
            order.append(run[places])
            self.start += [self.start[-1] + s for s in starts[1:]]
        rows = np.concatenate(order)
        self.ids, self.labels, self.vectors = ids[rows], labels[rows], vectors[rows]
        at = self.start[:-1]
        self.leaves = len(at)
        levels = [(np.minimum.reduceat(self.vectors, at), np.maximum.reduceat(self.vectors, at), np.minimum.reduceat(self.labels, at),
                   np.maximum.reduceat(self.labels, at), np.minimum.reduceat(self.ids, at))]
        self.children: list[range] = []
        below = 0
        while (n := len(levels[-1][0])) > 1:
            at = list(range(0, n, FAN))
            self.children += [range(below + k, below + min(k + FAN, n)) for k in at]
            below += n
            levels.append(tuple((np.maximum if k in (1, 3) else np.minimum).reduceat(x, at) for k, x in enumerate(levels[-1])))
        self.low, self.high, label_low, label_high, least = (np.concatenate(x) for x in zip(*levels, strict=True))
        self.label_low, self.label_high, self.least = label_low, label_high, least
        self._fits: dict[tuple[int, bool], np.ndarray] = {}
        self._first, self._last = (np.array(x, np.int64) for x in ([c.start for c in self.children], [c.stop for c in self.children]))
        self._most = int(np.abs(self.vectors).max(initial=0))
        self._as: tuple = ()

    def fits(self, label: int, same: bool) -> np.ndarray:
        """Of each box, whether it has rows of the label, or of others."""
        if (label, same) not in self._fits:
            low, high = self.label_low, self.label_high
            self._fits[label, same] = (low <= label) & (label <= high) if same else (low != label) | (high != label)
        return self._fits[label, same]

    def reached(self, ok: np.ndarray) -> np.ndarray:
        """The leaves that are ok under boxes that are, level by level from the root."""
        nodes = np.array([len(ok) - 1])
        while True:
            nodes = nodes[ok[nodes]]
            if not len(nodes) or nodes[0] < self.leaves:
                return nodes
            below = self._first[nodes - self.leaves][:, None] + np.arange(FAN)
            nodes = below[below < self._last[nodes - self.leaves][:, None]]

    def ask(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchors and rows as one kind of number, and the least and greatest score of each anchor in each box."""
        d, own = anchors.shape[1], self.vectors.shape[1]
        width = max(d, own)
        wide = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1])))
        most = width * int(np.abs(anchors).max(initial=0)) * self._most
        if most >= 1 << 62:
            raise ValueError("a score does not fit 62 bits")
        kind = np.float64 if most < 1 << 53 else np.int64  # sums of doubles are exact up to there
        if self._as[:2] != (kind, width):  # kept for the next block
            self._as = kind, width, *(wide(x).astype(kind) for x in (self.vectors, self.low, self.high))
        q, (rows, low, high) = wide(anchors).astype(kind), self._as[2:]
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return q, rows, up @ low.T + down @ high.T, up @ high.T + down @ low.T


class Scores:
    """Scores of a block's anchors with a tree's rows: a leaf is scored for all of them when the first opens it."""

    def __init__(self, tree: Tree, q: np.ndarray, rows: np.ndarray):
        self._start, self._q, self._rows = tree.start, q, rows
        self._leaves: dict[int, np.ndarray] = {}

    def of(self, k: int, leaf: int) -> np.ndarray:
        if leaf not in self._leaves:
            self._leaves[leaf] = self._q @ self._rows[self._start[leaf] : self._start[leaf + 1]].T
        return self._leaves[leaf][k]


class Asked:
    """One anchor's searches in a tree: leaves are scored when a search first opens them, or another anchor of the block has."""

    def __init__(self, tree: Tree, q: np.ndarray, rows: np.ndarray, least: np.ndarray, most: np.ndarray, anchor: int, label: int, same: bool, block: Scores | None = None, place: int = 0):
        self._tree, self._anchor, self._same = tree, anchor, same
        self._block, self._place = block or Scores(tree, q[None], rows), place
        self._least, self._most = least, most
        self._scored: set[int] = set()
        self._new = tree.fits(label, same).copy()  # boxes to look into, but for scored leaves
        self._scores, self._ids = np.zeros(0, np.int64), np.zeros(0, np.int64)  # of the fitting rows of scored leaves

    def _score(self, leaves: np.ndarray) -> None:
        """Scores and ids of the leaves' rows join those of the leaves scored before (a leaf has one label, so all its rows fit)."""
        t, each = self._tree, leaves.tolist()
        score = np.concatenate([self._block.of(self._place, x) for x in each]).astype(np.int64)
        ids = np.concatenate([t.ids[t.start[x] : t.start[x + 1]] for x in each])
        if self._same:
            others = ids != self._anchor
            score, ids = score[others], ids[others]
        self._scored.update(each)
        self._new[leaves] = False
        self._scores, self._ids = np.concatenate((self._scores, score)), np.concatenate((self._ids, ids))

    def _kept(self, want: int, floor: float, top: float) -> list[tuple[int, int]]:
        """The first ``want`` scored rows in the window, as (score, id)."""
        at = np.flatnonzero((self._scores >= floor) & (self._scores <= top))
        score = self._scores[at]
        if len(at) > want:
            last = score >= np.partition(score, len(at) - want)[len(at) - want]
            at, score = at[last], score[last]
        order = np.lexsort((self._ids[at], -score))[:want]
        return list(zip(score[order].tolist(), self._ids[at[order]].tolist(), strict=True))

    def first(self, want: int, lowest: int | None = None, highest: int | None = None) -> list[tuple[int, int]]:
        """The first ``want`` fitting rows with a score in the window, as (score, id). Leaves are
        opened best first, one, then two, four and so on between looks at the rows kept."""
        t, least, most = self._tree, self._least, self._most
        top = int(most[-1]) if highest is None else min(highest, int(most[-1]))
        floor = int(least[-1]) if lowest is None else max(lowest, int(least[-1]))
        queue = t.reached(self._new & (most >= floor) & (least <= top))
        best, first_id = np.minimum(most[queue], top), t.least[queue]
        order = np.lexsort((first_id, -best))
        queue, best, first_id = queue[order], best[order], first_id[order]
        kept, at, step = self._kept(want, floor, top) if self._scored else [], 0, 1
        while at < len(queue):
            end = min(at + step, len(queue))
            if len(kept) == want:
                score, last = kept[-1]
                end = at + np.count_nonzero((best[at:end] > score) | ((best[at:end] == score) & (first_id[at:end] < last)))
                if at == end:
                    break
            self._score(queue[at:end])
            kept, at, step = self._kept(want, floor, top), end, 2 * step
        return kept


def shards(rows: DataFrame, n: int, coordinate: int, size: int = SHARD) -> DataFrame:
    """The rows of each shard in one row: shard (0, 1, ...), ids, labels, vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy(zero_copy_only=False))
            labels.append(batch.column(1).to_numpy(zero_copy_only=False))
            vectors += [np.asarray(x) for x in batch.column(2).to_numpy(zero_copy_only=False)]
        if vectors:
            x = _matrix(vectors)
            shard = [TaskContext.get().partitionId(), x.shape[1], *(y.astype("<i8").tobytes() for y in (np.concatenate(ids), np.concatenate(labels))), x.astype("<i4").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([y]) for y in shard], ["shard", "width", "ids", "labels", "vectors"])

    at = F.coalesce(F.try_element_at("vector", F.lit(coordinate + 1)), F.lit(0))
    dealt = rows.repartitionByRange(max(1, -(-n // size)), F.col("label"), at, F.xxhash64("vec_id"))
    return dealt.select("vec_id", "label", "vector").mapInArrow(run, "shard long, width long, ids binary, labels binary, vectors binary")


def _meet(blocks: DataFrame, packed: DataFrame) -> DataFrame:
    """Each shard, and after it the blocks of anchors, all in one task: a block is sent to every shard.

    No join: Spark would choose the side that it broadcasts through the driver by its size as
    Parquet, which tells little of shards whose vectors compress, and nothing of blocks times shards."""
    last = packed.agg(F.max("shard")).first()[0]
    number = F.sequence(F.lit(0).cast("long"), F.lit(last)) if last is not None else F.array().cast("array<long>")
    tasks = min((last or 0) + 1, int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    each = blocks.select("anchors", F.explode(number).alias("shard"))
    dealt = packed.unionByName(each, allowMissingColumns=True).repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int"))
    return dealt.sortWithinPartitions("shard", F.isnotnull("anchors"))


def _searched(met: DataFrame, want: int, low: int, high: int, negatives: bool) -> DataFrame:
    """The first rows of each anchor (and each of its positives' windows) in each shard."""
    shape = "anchor_id long, place int, positive_id long, positive_score long, found_id long, found_score long"
    names = [column.split(" ")[0] for column in shape.split(", ")]
    met = met.select("shard", "width", "ids", "labels", "vectors", "anchors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, tree = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                shard, width, anchors = (batch.column(c)[k].as_py() for c in (0, 1, 5))
                if anchors is None:
                    ids, labels = (np.frombuffer(batch.column(c)[k].as_buffer(), "<i8") for c in (2, 3))
                    number, tree = shard, Tree(ids, labels, np.frombuffer(batch.column(4)[k].as_buffer(), "<i4").reshape(len(ids), width).astype(np.int64))
                    continue
                if shard != number:  # the number of an empty shard
                    continue
                q, rows, least, most = tree.ask(_matrix([np.array(a["vector"], np.int64) for a in anchors]))
                block = Scores(tree, q, rows)
                out: list[tuple] = []
                for at, a in enumerate(anchors):
                    asked = Asked(tree, q[at], rows, least[at], most[at], a["vec_id"], a["label"], not negatives, block, at)
                    if not negatives:
                        out += [(a["vec_id"], 0, None, None, i, s) for s, i in asked.first(want)]
                        continue
                    for p in a["positives"]:
                        floor, top = -(-low * p["score"] // 100), high * p["score"] // 100
                        out += [(a["vec_id"], p["place"], p["id"], p["score"], i, s) for s, i in (asked.first(want, floor, top) if floor <= top else [])]
                columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
                kinds = [pa.int32() if n == "place" else pa.int64() for n in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    return met.mapInArrow(run, shape)


def _first(found: DataFrame, keys: list[str], want: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("found_score").desc(), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= want)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels with low * positive_score <= 100 * negative_score <=
    high * positive_score. ``rows`` (vec_id, label, vector: integers) is a stored table,
    ``anchors`` some of its rows."""
    n = rows.count()
    packed = stored(shards(rows, n, widest(rows)), "shards")
    one = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("x")).select("vec_id", "x.label", "x.vector")
    one = stored(one, "anchors")
    blocks = max(1, -(-one.count() // BLOCK))

    def dealt(df: DataFrame, *more: str) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")
        return df.groupBy(block).agg(F.collect_list(F.struct("vec_id", "label", "vector", *more)).alias("anchors"))

    near = _first(_searched(_meet(dealt(one), packed), positives, low, high, negatives=False), ["anchor_id"], positives)
    lists = near.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("rank").alias("place"), F.col("found_id").alias("id"), F.col("found_score").alias("score"))).alias("positives"))
    asking = one.hint("merge").join(lists, one["vec_id"] == lists["anchor_id"]).drop("anchor_id")
    found = _searched(_meet(dealt(asking, "positives"), packed), negatives, low, high, negatives=True)
    return _first(found, ["anchor_id", "place"], negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"), "positive_score", F.col("found_score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scaled(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = stored(rows.withColumn("label", moved), "vectors")
    return hard_negatives(rows, rows.where(F.col("vec_id") % 100 == 0))
