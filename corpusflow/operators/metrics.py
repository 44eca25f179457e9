"""Ingest metrics as aggregations over an ingest log.

Log columns: ts, source_type, collection, n_docs, n_chunks, embed_requests,
embed_errors, skipped, duration_s, ok. Each sample is a row
``metric, labels (map), value``; every aggregation is a hash aggregate with
map-side partial results, keyed by a handful of label values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K


def _labels(*pairs: tuple[str, Column]) -> Column:
    if not pairs:
        return F.create_map().cast("map<string,string>")
    args = []
    for k, v in pairs:
        args += [F.lit(k), v.cast("string")]
    return F.create_map(*args)


def _sample(metric: str, labels: Column, value: Column) -> list[Column]:
    return [F.lit(metric).alias("metric"), labels.alias("labels"), value.cast("double").alias("value")]


#: name, type and help of every metric family, in the order of the exposition.
FAMILIES = (
    (K.METRIC_DOCUMENTS, "counter", "Documents of successful ingests by source type and collection."),
    (K.METRIC_CHUNKS, "counter", "Chunks of successful ingests by collection."),
    (K.METRIC_DURATION, "histogram", "Seconds of successful ingests by source type."),
    (K.METRIC_EMBED_REQUESTS, "counter", "Requests to the embedder."),
    (K.METRIC_EMBED_ERRORS, "counter", "Requests to the embedder that failed."),
    (K.METRIC_LAST_INGEST, "gauge", "Unix time of the last successful ingest by collection."),
    (K.METRIC_SKIPPED, "counter", "Chunks skipped, by reason."),
)


def samples(log: DataFrame, families: tuple[str, ...], buckets: tuple[float, ...] = K.DURATION_BUCKETS) -> DataFrame:
    """A6-A8 in one pass: grouping sets over one scan of the log give the sums of every label set.

    A row of zeros joins the input, so totals without labels exist (as 0) for an empty log too;
    labelled families have samples for the label values with a successful ingest.
    """
    ok = F.coalesce(F.col("ok"), F.lit(False))
    columns = ["source_type", "collection", "n_docs", "n_chunks", "duration_s", "embed_requests", "embed_errors", "skipped", "ok"]
    zero = log.sparkSession.range(1).select(*[F.lit(None).cast(log.schema[c].dataType).alias(c) for c in (*columns, "ts")])
    rows = log.select(*columns, "ts").unionByName(zero)
    le = [F.count_if(ok & (F.col("duration_s") <= b)).alias(f"b{i}") for i, b in enumerate(buckets)]
    sums = rows.groupingSets([["source_type", "collection"], ["collection"], ["source_type"], []], "source_type", "collection").agg(
        F.grouping_id().alias("_set"), F.count_if(ok).alias("n_ok"), *le,
        *[F.sum(F.when(ok, F.col(c))).alias(c) for c in ("n_docs", "n_chunks", "duration_s")], F.max(F.when(ok, F.col("ts"))).alias("ts"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("embed_requests", "embed_errors", "skipped")],
    )
    src, coll = ("source_type", F.col("source_type")), ("collection", F.col("collection"))

    def sample(family: str, value: Column, *labels: tuple[str, Column], suffix: str = "") -> list[Column]:
        return [F.struct(*_sample(family + suffix, _labels(*labels), value))] if family in families else []

    duration = []
    for i, b in enumerate([*buckets, None]):
        bound = F.lit("+Inf" if b is None else _fmt(b))
        duration += sample(K.METRIC_DURATION, F.col("n_ok" if b is None else f"b{i}"), ("le", bound), src, suffix="_bucket")
    duration += sample(K.METRIC_DURATION, F.round("duration_s", 6), src, suffix="_sum")
    duration += sample(K.METRIC_DURATION, F.col("n_ok"), src, suffix="_count")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    by_set = {
        0: sample(K.METRIC_DOCUMENTS, F.col("n_docs"), coll, src),
        1: duration,
        2: sample(K.METRIC_CHUNKS, F.col("n_chunks"), coll) + sample(K.METRIC_LAST_INGEST, seconds, coll),
        3: sample(K.METRIC_EMBED_REQUESTS, F.col("embed_requests")) + sample(K.METRIC_EMBED_ERRORS, F.col("embed_errors"))
        + sample(K.METRIC_SKIPPED, F.col("skipped"), ("reason", F.lit("already_indexed"))),
    }
    out = None
    for number, found in by_set.items():
        if found:
            here = (F.col("_set") == number) & ((F.col("n_ok") > 0) | F.lit(number == 3))
            out = F.when(here, F.array(*found)) if out is None else out.when(here, F.array(*found))
    return sums.select(F.explode(out).alias("s")).select("s.metric", "s.labels", "s.value")


def counter_metrics(log: DataFrame) -> DataFrame:
    """Labelled counter sums (successful ingests only count documents/chunks)."""
    return samples(log, (K.METRIC_DOCUMENTS, K.METRIC_CHUNKS, K.METRIC_EMBED_REQUESTS, K.METRIC_EMBED_ERRORS, K.METRIC_SKIPPED))


def duration_histogram(log: DataFrame, buckets: tuple[float, ...] = K.DURATION_BUCKETS) -> DataFrame:
    """Cumulative buckets (``le``), sum and count per source type, successful ingests."""
    return samples(log, (K.METRIC_DURATION,), buckets)


def _fmt(b: float) -> str:
    return f"{float(b)}"


def last_ingest(log: DataFrame) -> DataFrame:
    """Last successful ingest time per collection (gauge, unix seconds)."""
    return samples(log, (K.METRIC_LAST_INGEST,))


def all_metrics(log: DataFrame) -> DataFrame:
    return samples(log, tuple(name for name, _, _ in FAMILIES))


def _escaped(value: Column) -> Column:
    """A label value in the text format: backslash, quote and line break escaped."""
    return F.replace(F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))


def exposition_line(metric: Column, labels: Column, value: Column) -> Column:
    """``name{k="v",...} value`` with labels sorted by key; no braces without labels."""
    entries = F.array_sort(F.map_entries(labels))
    quoted = F.transform(entries, lambda e: F.concat(e["key"], F.lit('="'), _escaped(F.coalesce(e["value"], F.lit(""))), F.lit('"')))
    lab = F.when(F.size(entries) > 0, F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}"))).otherwise(F.lit(""))
    return F.concat(metric, lab, F.lit(" "), _num(value))


def _num(v: Column) -> Column:
    """Number as text: integers without a fraction, others with up to 6 decimals."""
    r = F.round(v, 6)
    return F.when(r == F.floor(r), F.floor(r).cast("bigint").cast("string")).otherwise(
        F.regexp_replace(F.format_string("%.6f", r), "0+$", "")
    )


def metrics_exposition(samples: DataFrame) -> DataFrame:
    """One text line per sample."""
    return samples.select(exposition_line(F.col("metric"), F.col("labels"), F.col("value")).alias("line"))


def metrics_text(samples: DataFrame) -> DataFrame:
    """A9 as a scraper reads it: per family its HELP line (part 0), TYPE line (1) and samples (2), in
    order: the buckets of a series by rising bound, then its sum and count."""
    family = F.regexp_replace("metric", f"^({K.METRIC_DURATION})_(bucket|sum|count)$", "$1")
    series = F.to_json(F.map_filter("labels", lambda k, _: k != "le"))
    bound = F.when(F.col("labels")["le"] == "+Inf", F.lit(float("inf"))).otherwise(F.col("labels")["le"].cast("double"))
    kind = F.when(F.col("metric").endswith("_sum"), 1).when(F.col("metric").endswith("_count"), 2).otherwise(0)
    lines = samples.select(family.alias("family"), F.lit(2).alias("part"), series.alias("_series"), kind.alias("_kind"), bound.alias("_bound"),
                           exposition_line(F.col("metric"), F.col("labels"), F.col("value")).alias("line"))
    heads = [(name, part, f"# {word} {name} {text}") for name, kind_, help_ in FAMILIES for part, word, text in ((0, "HELP", help_), (1, "TYPE", kind_))]
    places = {name: k for k, (name, _, _) in enumerate(FAMILIES)}
    order = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])[F.col("family")]
    head_lines = lines.sparkSession.createDataFrame(heads, "family string, part int, line string")
    every = lines.unionByName(head_lines, allowMissingColumns=True)
    return every.orderBy(order, "part", "_series", "_kind", "_bound").select("family", "part", "line")


def embed_throughput(log: DataFrame, by: tuple[str, ...] = ("collection",)) -> DataFrame:
    """A10: embedded texts per second; 0 when no time elapsed (division guarded for ANSI mode)."""
    g = log.groupBy(*by).agg(F.sum("n_chunks").alias("texts"), F.sum("duration_s").alias("seconds"))
    rate = F.coalesce(F.col("texts") / F.nullif(F.col("seconds"), F.lit(0.0)), F.lit(0.0))
    return g.select(*by, "texts", F.round("seconds", 6).alias("seconds"), F.round(rate, 6).alias("texts_per_s"))
