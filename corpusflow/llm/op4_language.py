"""Language identification: averaged hashed subword embeddings, linear softmax.

Subwords are two to four bytes of lower-cased words (word edges count), hashed
into ``BUCKETS`` rows of an embedding; a text is the mean of its rows, a linear
layer gives one logit per language. numpy fits both by stochastic gradient
descent on a bounded sample of labelled rows. Because mean and layer are linear,
tasks apply a table of logits per bucket. A temperature and a rejection bound
come from sample rows that training left out.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a
row without language is predicted but not learned from; repeated rows are alike;
without any labelled row everything is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import bytewise as bw
from .common import slices, table

BITS, DIM = 15, 16
BUCKETS = 1 << BITS
#: Sampled rows per language, about: a row is taken if its hash falls under the
#: share that makes so many (bounded however large the table is).
FIT_ROWS = 800
EPOCHS, RATE = 4, 0.5
#: Share of right predictions on left-out rows that the rejection bound gives up.
GIVEN_UP = 0.001
SMOOTHING = 0.02
UNKNOWN = "und"
_ASCII_LETTER = re.compile("[A-Za-z]")
_EDGE = 32
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[: 0x80] = _EDGE
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text))


def subwords(buf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length 2, 3, 4: bucket of the subword at each place, and whether it is
    one (at most its ends are word edges)."""
    b = np.append(_FOLD[buf], np.full(3, _EDGE, np.uint8))
    edge = b == _EDGE
    n = len(buf)
    code = b[:n].astype(np.uint32)
    inner = np.ones(n, bool)
    for size in (2, 3, 4):
        code = code | (b[size - 1 : n + size - 1].astype(np.uint32) << np.uint32(8 * (size - 1)))
        whole = inner & ~(edge[:n] & edge[size - 1 : n + size - 1])
        salted = (code ^ np.uint32(0x9E3779B9 * size & 0xFFFFFFFF)) * np.uint32(2654435761)
        yield ((salted ^ (salted >> np.uint32(15))) * np.uint32(2246822519)) >> np.uint32(32 - BITS), whole
        inner &= ~edge[size - 1 : n + size - 1]


def _padded(part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts lower-cased beyond ASCII too, with an edge around each."""
    raw = [x if x.isascii() else x.decode("utf-8", "replace").lower().encode("utf-8", "replace") for x in part]
    buf = np.frombuffer(b"  " + b"  ".join(raw) + b"  ", np.uint8)
    starts = np.cumsum([1] + [len(x) + 2 for x in raw[:-1]])
    return buf, starts


def _cut(buf: np.ndarray, limit: int = bw.CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of a padded buffer that each start and end on a word edge (only a longer
    word makes one longer): neighbours share that byte, and no subword is lost or
    counted twice, as none has an edge inside and two edges are none."""
    at, last = 0, len(buf) - 1
    while at < last:
        end = min(at + limit, last)
        while end < last and _FOLD[buf[end]] != _EDGE:
            end += 1
        yield at, end + 1
        at = end


@dataclass(frozen=True)
class Model:
    langs: list[str]
    logits: np.ndarray  # [bucket, language]
    bias: np.ndarray
    temperature: float
    bound: float  # a score under it is rejected

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        found: list[np.ndarray] = []
        for part, _, _ in bw.chunks(texts):
            buf, starts = _padded(part)
            total, count = np.zeros((len(part), len(self.langs))), np.zeros(len(part))
            for a, b in _cut(buf):
                # texts of the range, the first and the last perhaps in part
                first, last = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, b, "left")
                text = slice(max(first, 0), last)
                begin = np.maximum(starts[text] - a, 0)
                if not len(begin):
                    continue
                for bucket, whole in subwords(buf[a:b]):
                    total[text] += np.add.reduceat(self.logits[np.where(whole, bucket, BUCKETS)], begin, axis=0)
                    count[text] += np.add.reduceat(whole, begin, dtype=np.int64)
            found.append(total / np.maximum(count, 1)[:, None] + self.bias)
        z = np.concatenate(found) / self.temperature if found else np.zeros((0, len(self.langs)))
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        known = np.array([has_letter(t) for t in texts], bool)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, p.max(1), 0.0)


def features(docs: DataFrame) -> DataFrame:
    """lang, and the buckets of each text with their shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                buf, _ = _padded([(text or "").encode("utf-8", "replace")])
                counts = np.zeros(BUCKETS)
                for bucket, whole in subwords(buf):
                    counts += np.bincount(bucket[whole], minlength=BUCKETS)
                at = np.flatnonzero(counts)
                share = (counts[at] / max(counts.sum(), 1)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([at.astype(np.int32).tobytes()]), pa.array([share.tobytes()])], ["lang", "bucket", "share"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, bucket binary, share binary")


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 3) -> Model | None:
    """Fit by gradient descent, one text at a time; every fifth row calibrates."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    y = np.array([langs.index(r[0]) for r in rows])
    left_out = np.arange(len(rows)) % 5 == 4
    if not left_out.any():
        left_out[:] = True
    learn = np.flatnonzero(~left_out) if (~left_out).any() else np.arange(len(rows))
    embed = rng.normal(0, 0.3, (BUCKETS, DIM))
    layer, bias = rng.normal(0, 0.3, (DIM, len(langs))), np.zeros(len(langs))
    weight = len(learn) / len(langs) / np.maximum(np.bincount(y[learn], minlength=len(langs)), 1)  # languages count alike
    steps, step = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(learn):
            at, share = rows[k][1], rows[k][2][:, None]
            h = (embed[at] * share).sum(0)
            z = h @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[k]] -= 1
            g = p * min(weight[y[k]], 5.0) * RATE * (1 - step / steps)
            embed[at] -= share * 40 * (layer @ g)
            layer -= np.outer(h, g)
            bias -= g * 0.1
            step += 1
    logits = embed @ layer
    check = np.flatnonzero(left_out)
    # Smoothed targets keep a score off 1 even where the left-out rows are all right.
    target = np.full((len(check), len(langs)), SMOOTHING / len(langs))
    target[np.arange(len(check)), y[check]] += 1 - SMOOTHING
    z = np.array([(logits[rows[k][1]] * rows[k][2][:, None]).sum(0) + bias for k in check])

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(1, keepdims=True)
        log_p = s - np.log(np.exp(s).sum(1, keepdims=True))
        return float(-(target * log_p).sum(1).mean())

    temperature = float(min(np.geomspace(0.05, 10, 60), key=loss))
    p = np.exp((z - z.max(1, keepdims=True)) / temperature)
    p /= p.sum(1, keepdims=True)
    right = p.max(1)[p.argmax(1) == y[check]]
    bound = min(float(np.quantile(right, GIVEN_UP)) if len(right) else 0.0, 0.5)
    return Model(langs, np.vstack([logits, np.zeros(len(langs))]).astype(np.float32), bias, temperature, bound)


def fit(docs: DataFrame, eligible: Column | None = None, fit_rows: int = FIT_ROWS) -> Model | None:
    """Sample about ``fit_rows`` eligible labelled rows per language and train.

    The share per language comes from a count over all rows (doc_id and lang only).
    """
    able = docs.where("text is not null and lang is not null")
    able = able if eligible is None else able.where(eligible)
    counted = docs.where("lang is not null") if eligible is None else docs.where("lang is not null").where(eligible)
    share = {r["lang"]: fit_rows / r["count"] for r in counted.groupBy("lang").count().collect()}
    if not share:
        return None
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = able.where(place < F.create_map(*[F.lit(x) for kv in share.items() for x in kv])[F.col("lang")])
    rows = [(r["lang"], np.frombuffer(r["bucket"], np.int32), np.frombuffer(r["share"], np.float32).astype(float))
            for r in features(chosen).collect()]
    rows.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))
    order = np.random.default_rng(5).permutation(len(rows))
    return train([rows[k] for k in order])


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add lang_pred, score and accepted to doc_id, text and any other columns
    (columns of ``docs`` that have these names are replaced)."""
    names = ["lang_pred", "score", "accepted"]
    kept = docs.drop(*names)
    at = kept.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a table of BUCKETS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            lang, score = model.predict(texts) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            good = [x != UNKNOWN and s >= model.bound for x, s in zip(lang, score, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(good, pa.bool_())], [*batch.schema.names, *names])

    shape = StructType(list(kept.schema.fields)).add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    return kept.mapInArrow(run, shape)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, ~held_out())
    found = predict(docs.select(F.col("doc_id").cast("long"), "text", held_out().alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")
