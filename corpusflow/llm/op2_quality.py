"""Quality rules with an isolation forest over rule statistics.

``rule_statistics`` measures every whole text in Arrow tasks. ``fit`` grows
random-split trees, each over rows drawn from all labelled ones, and calibrates the
anomaly threshold on all labels; ``score`` walks the trees over every row.

Defined cases: a null text counts as empty; an empty or blank text has no words
and fails the base rules; repeated rows are judged alike; an empty table gives an
empty result; without labelled rows only the base rules decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytewise as bw
from .common import stored, table

#: An isolation forest: trees, and rows that the method draws for each of them from all labelled ones.
TREES, SUBSAMPLE, SEED = 200, 256, 7
#: Ranges of scores by which the labels are summed up.
PARTS = 4096
#: A good row flagged costs as much as so many bad rows missed, as shares of their class.
ALARM_COST = 5.0

# Byte classes: white space, symbol of the contract, upper case, exclamation
# mark, continuation byte of a longer code point, anything else.
SPACE, SYMBOL, UPPER, BANG, TAIL, OTHER = range(6)
_CLASS = np.full(256, OTHER, np.int64)
_CLASS[bw.IS_SPACE] = SPACE
_CLASS[list(b"#*$%&|<>")] = SYMBOL
_CLASS[65:91] = UPPER
_CLASS[ord("!")] = BANG
_CLASS[0x80:0xC0] = TAIL

#: The statistics that isolate labelled bad rows. A forest that also sees the shares of repeated lines and
#: words and the length flags more good rows and catches no more bad ones (figures in the README).
FEATURES = ("symbols", "bangs", "upper", "word_length")
STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " + \
    ", ".join(f"f_{x} double" for x in FEATURES)


def _repeated(group: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Mark members whose (group, hash) occurs twice or more."""
    key = bw.mix(h + group.astype(bw.U) * bw.U(0xC2B2AE3D27D4EB4F))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _distinct(group: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct hashes per group."""
    key = bw.mix(h + group.astype(bw.U) * bw.U(0xC2B2AE3D27D4EB4F))
    _, first = np.unique(key, return_index=True)
    return np.bincount(group[first], minlength=n)


def measure(texts: list[str | None]) -> dict[str, np.ndarray]:
    """Contract counts and forest features of each text."""
    found: list[dict[str, np.ndarray]] = []
    for part, buf, offsets in bw.chunks(texts):
        n = len(part)
        roll = bw.Rolling(buf)
        starts, ends = bw.words(buf)
        doc = bw.owner(starts, offsets)
        h = roll.of(starts, ends)
        n_words = np.bincount(doc, minlength=n)
        classes = np.bincount(np.repeat(np.arange(n) * 6, np.diff(offsets)) + _CLASS[buf], minlength=n * 6).reshape(n, 6)
        classes[:, SPACE] -= 1  # the break between texts
        word_chars = classes.sum(1) - classes[:, TAIL] - classes[:, SPACE]
        repeat = np.zeros(len(h), bool)
        if len(h) > 2:
            inside = np.flatnonzero(doc[:-2] == doc[2:])
            hit = inside[_repeated(doc[inside], bw.triples(h)[inside])]
            for k in range(3):
                repeat[hit + k] = True
        n_repeat = np.bincount(doc[repeat], minlength=n)
        stop = np.flatnonzero(buf == 10)
        start = np.concatenate(([0], stop[:-1] + 1))
        wordy = np.searchsorted(starts, stop) > np.searchsorted(starts, start)
        start, stop = start[wordy], stop[wordy]
        line_doc = bw.owner(start, offsets)
        n_lines = np.bincount(line_doc, minlength=n)
        dup_lines = n_lines - _distinct(line_doc, roll.of(start, stop), n)
        w, c = np.maximum(n_words, 1), np.maximum(word_chars, 1)
        found.append({
            "n_words": n_words, "word_chars": word_chars, "n_symbols": classes[:, SYMBOL], "n_dup_lines": dup_lines,
            "n_repeat_words": n_repeat, "f_symbols": classes[:, SYMBOL] / w, "f_bangs": classes[:, BANG] / w,
            "f_upper": classes[:, UPPER] / c, "f_word_length": word_chars / w,
        })
    return {k: np.concatenate([x[k] for x in found]) for k in found[0]} if found else {}


def rule_statistics(docs: DataFrame) -> DataFrame:
    """One row of counts and features per row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = measure(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, got.values())], ["doc_id", *got])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, STATS)


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree over n points."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n < 2, 0.0, np.where(n == 2, 1.0, 2 * (np.log(safe - 1) + 0.5772156649) - 2 * (safe - 1) / safe))


@dataclass(frozen=True)
class Forest:
    """Complete binary trees of fixed depth as arrays [tree, node]."""

    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray
    depth: int
    norm: float
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): 2 ** -(mean path length / expected length)."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, path in zip(self.feature, self.cut, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += path[node]
        return np.exp2(-total / len(self.path) / self.norm)


def grow(drawn: np.ndarray, rng: np.random.Generator) -> Forest:
    """Grow the forest: each tree isolates its random subsample (drawn [tree, row, feature]) by random splits."""
    trees, size, features = drawn.shape
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.zeros((trees, nodes), np.int64)
    cut = np.full((trees, nodes), np.inf)  # an unsplit node sends everything left
    path = np.zeros((trees, nodes))
    for t in range(trees):
        todo = [(0, 0, drawn[t], None)]
        while todo:
            node, level, rows, fixed = todo.pop()
            spread = rows.max(0) - rows.min(0) if fixed is None and len(rows) > 1 else np.zeros(features)
            if fixed is None and (level == depth or not spread.any()):
                fixed = level + float(_average_path(len(rows)))
            if level == depth:
                path[t, node] = fixed
                continue
            if fixed is None:
                f = rng.choice(np.flatnonzero(spread))
                low, high = rows[:, f].min(), rows[:, f].max()
                at = rng.uniform(low, high)
                feature[t, node], cut[t, node] = f, at
                right = rows[:, f] > at
                todo += [(2 * node + 1, level + 1, rows[~right], None), (2 * node + 2, level + 1, rows[right], None)]
            else:
                todo += [(2 * node + 1, level + 1, rows[:1], fixed), (2 * node + 2, level + 1, rows[:1], fixed)]
    return Forest(feature, cut, path, depth, float(max(_average_path(size), 1e-9)), 1.0)


def _grown(rows: DataFrame, trees: int) -> Forest | None:
    """The forest of ``rows``, stored in order of doc_id with ``at``, their place in the table: every tree
    draws its subsample from all of them, and only rows that are drawn reach the driver."""
    parts = rows.groupBy(F.shiftright("at", 33).alias("part")).count().orderBy("part").collect()  # one per stored part
    ends = np.cumsum([r["count"] for r in parts])
    n = int(ends[-1]) if parts else 0
    if n < 2:
        return None
    rng, size = np.random.default_rng(SEED), min(SUBSAMPLE, n)
    draws = np.array([rng.choice(n, size, replace=False) for _ in range(trees)])
    part = np.searchsorted(ends, draws, "right")
    at = (np.array([r["part"] for r in parts])[part] << 33) + draws - (ends - [r["count"] for r in parts])[part]
    places = np.unique(at)
    drawn = rows.sparkSession.createDataFrame(pd.DataFrame({"at": places}))
    got = rows.join(F.broadcast(drawn), "at").select("at", *[f"f_{x}" for x in FEATURES]).toPandas().sort_values("at")
    return grow(got.iloc[:, 1:].to_numpy(float)[np.searchsorted(places, at)], rng)


def _calibrated(rows: DataFrame, forest: Forest, alarm_cost: float) -> float:
    """The least score at which most bad rows are caught less ``alarm_cost`` times good rows flagged, over
    all ``rows``: rows of each score are counted and summed up in order, first by ranges of scores."""
    columns = [f"f_{x}" for x in FEATURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
            yield pa.RecordBatch.from_arrays([pa.array(forest.scores(x)), batch.column("good")], ["s", "good"])

    scored = rows.select((F.col("quality") == 1).alias("good"), *columns).mapInArrow(run, "s double, good boolean")
    counts = stored(scored.groupBy("s").agg(F.count_if(~F.col("good")).alias("bad"), F.count_if("good").alias("good")), "score_counts")
    counts = counts.withColumn("part", F.floor(F.col("s") * PARTS))
    total = counts.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    if not total["bad"] or not total["good"]:
        return 1.0
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over at most PARTS + 1 rows
    sums = counts.groupBy("part").agg(F.sum("bad").alias("b"), F.sum("good").alias("g"))
    sums = sums.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("b", "g")])
    upto = Window.partitionBy("part").orderBy("s")
    caught = 1 - (F.col("b") + F.sum("bad").over(upto)) / F.lit(total["bad"])
    alarms = 1 - (F.col("g") + F.sum("good").over(upto)) / F.lit(total["good"])
    worth = counts.join(F.broadcast(sums), "part").select("s", (caught - F.lit(float(alarm_cost)) * alarms).alias("worth"))
    return -worth.agg(F.max(F.struct("worth", (-F.col("s")).alias("less"))).alias("best")).first()["best"]["less"]


def fit(stats: DataFrame, labels: DataFrame, trees: int = TREES, alarm_cost: float = ALARM_COST) -> Forest | None:
    """Grow on labelled rows that pass the base rules and calibrate the threshold on the labels
    of all of them. A doc_id with several labels or rows has the least of them."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    row = F.struct("quality", *[f"f_{x}" for x in FEATURES])
    able = stats.where(~base_failed()).join(marked, "doc_id").groupBy("doc_id").agg(F.min(row).alias("row"))
    rows = stored(able.select("doc_id", "row.*").sort("doc_id").withColumn("at", F.monotonically_increasing_id()), "labelled")
    forest = _grown(rows, trees)
    return forest and replace(forest, threshold=_calibrated(rows, forest, alarm_cost))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def score(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """Add ``anomaly`` (score, 0 without a forest) and ``anomalous``."""
    columns = [f"f_{x}" for x in FEATURES]
    shape = f"{STATS}, anomaly double, anomalous boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
            s = np.zeros(len(x)) if forest is None else forest.scores(x)
            flag = s > (1.0 if forest is None else forest.threshold)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array(flag)], [*batch.schema.names, "anomaly", "anomalous"])

    return stats.mapInArrow(run, shape)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base verdict, anomaly score and final verdict per document."""
    stats = stored(rule_statistics(docs), "rule_statistics")
    return (
        score(stats, fit(stats, labels))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~F.col("anomalous"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", F.round("anomaly", 6).alias("anomaly"))
