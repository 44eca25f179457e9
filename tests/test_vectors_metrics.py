"""D1, F9, F10, A6-A10."""

import math

import numpy as np
from pyspark.sql import functions as F

from corpusflow.functions.embedding import HashingEmbedder, embed_frame
from corpusflow.functions.vectors import l2_normalize, quantile_bounds, quantize_int8
from corpusflow.operators import metrics as M


def test_embedding_deterministic_unit_length(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "Hello, hello WORLD!")], "k int, text string")
    rows = {r["k"]: np.array(r["vector"]) for r in embed_frame(df).collect()}
    assert abs(np.linalg.norm(rows[1]) - 1) < 1e-6
    assert not rows[2].any() and not rows[3].any()
    local = HashingEmbedder(64).embed(["hello world"])[0]
    assert np.array_equal(rows[1], local)


def test_l2_normalize_zero_stays_zero(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    got = [r["n"] for r in df.select(l2_normalize("v").alias("n")).collect()]
    assert got[0] == [0.6000000238418579, 0.800000011920929] and got[1] == [0.0, 0.0]


def test_quantile_bounds_exact_and_sketch(spark):
    rng = np.random.default_rng(7)
    vecs = rng.normal(size=(400, 16)).astype(np.float32)
    vecs[:50] = 0.0  # a block of ties
    df = spark.createDataFrame([("c", v.tolist()) for v in vecs], "collection string, vector array<float>")
    flat = np.sort(vecs.reshape(-1).astype(np.float64))
    n = flat.size
    want_lo, want_hi = flat[max(math.ceil(0.005 * n), 1) - 1], flat[max(math.ceil(0.995 * n), 1) - 1]
    for acc in (8, 200, 4_096):  # a coarse sketch still gives the exact value
        b = quantile_bounds(df, k=acc).first()
        assert (b["q_lo"], b["q_hi"]) == (want_lo, want_hi)
    a = quantile_bounds(df, exact=False).first()
    lo_rank = int(np.searchsorted(flat, a["q_lo"], side="right"))
    assert abs(lo_rank - math.ceil(0.005 * n)) <= 1
    codes = quantize_int8(df).select("codes").collect()
    allc = np.array([c for r in codes for c in r["codes"]])
    assert allc.min() == -128 and allc.max() == 127


def test_metrics_histogram_cumulative_and_exposition(spark):
    import datetime as dt

    log = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "web", "docs", 1, 10, 1, 0, 0, 0.5, True),
         (dt.datetime(2024, 1, 2), "web", "docs", 2, 20, 1, 0, 3, 7.0, True),
         (dt.datetime(2024, 1, 3), "git", "docs", 1, 5, 1, 1, 0, 700.0, False)],
        "ts timestamp, source_type string, collection string, n_docs long, n_chunks long, embed_requests long, "
        "embed_errors long, skipped long, duration_s double, ok boolean",
    )
    h = {(r["metric"], r["labels"].get("le")): r["value"] for r in M.duration_histogram(log).collect()}
    assert h[("ingest_duration_seconds_bucket", "1.0")] == 1 and h[("ingest_duration_seconds_bucket", "10.0")] == 2
    assert h[("ingest_duration_seconds_bucket", "+Inf")] == 2
    lines = {r["line"] for r in M.metrics_exposition(M.all_metrics(log)).collect()}
    assert 'documents_ingested_total{collection="docs",source_type="web"} 3' in lines
    assert "embed_errors_total 1" in lines
    t = M.embed_throughput(log.where(F.lit(False))).collect()
    assert t == []


def test_exact_quantiles_narrow_huge_brackets(spark):
    from corpusflow.functions.vectors import exact_quantiles

    rng = np.random.default_rng(3)
    x = rng.normal(size=20000)
    df = spark.createDataFrame([("g", float(v)) for v in x], "g string, x double")
    srt = np.sort(x)
    # a small sketch leaves wide brackets, which the rounds narrow
    got = {r["_qi"]: r["value"] for r in exact_quantiles(df, "x", ("g",), (0.005, 0.5, 0.995), k=64, rounds=3).collect()}
    for i, q in enumerate((0.005, 0.5, 0.995)):
        assert got[i] == srt[max(math.ceil(q * len(x)), 1) - 1]


class _LengthModel:
    """A stand-in model: [len(text), 1.0]."""

    def embed(self, texts):
        return np.array([[float(len(t)), 1.0] for t in texts], dtype=np.float32)


def test_registered_model_runs_on_workers(spark):
    from corpusflow.functions.embedding import register_model

    register_model("length", _LengthModel)
    df = spark.createDataFrame([(1, "abc"), (2, "")], "k int, text string")
    got = {r["k"]: r["vector"] for r in embed_frame(df, model="length", dim=2).collect()}
    assert got == {1: [3.0, 1.0], 2: [0.0, 1.0]}


def test_quantile_bounds_are_one_plan(spark):
    import inspect

    from corpusflow.functions import vectors

    assert "collect()" not in inspect.getsource(vectors) and "checkpoint" not in inspect.getsource(vectors)
    df = spark.createDataFrame([("a", [1.0, None, 2.0]), ("b", [5.0]), ("c", None), ("d", [])], "collection string, vector array<double>")
    got = {r["collection"]: (r["q_lo"], r["q_hi"]) for r in quantile_bounds(df).collect()}
    assert got == {"a": (1.0, 2.0), "b": (5.0, 5.0)}


_LOG = ("ts timestamp, source_type string, collection string, n_docs long, n_chunks long, embed_requests long, embed_errors long, "
        "skipped long, duration_s double, ok boolean")


def test_metrics_read_the_log_once_and_escape_labels(spark, scratch):
    import datetime as dt

    odd = 'a"b\\c\nd'
    log = spark.createDataFrame([(dt.datetime(2024, 1, 1), "web", odd, 1, 10, 1, 0, 2, 0.5, True), (dt.datetime(2024, 1, 1), "git", "x", 1, 1, 1, 1, 0, 2.0, None)], _LOG)
    log.write.parquet(scratch)
    found = M.metrics_text(M.all_metrics(spark.read.parquet(scratch)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Scan parquet") == 1
    lines = [r["line"] for r in found.collect()]
    assert r'chunks_created_total{collection="a\"b\\c\nd"} 10' in lines
    assert not any('collection="x"' in line for line in lines)  # no successful ingest there
    assert "embed_errors_total 1" in lines and 'documents_skipped_total{reason="already_indexed"} 2' in lines
    for name, kind, _ in M.FAMILIES:
        at = lines.index(f"# TYPE {name} {kind}")
        assert lines[at - 1].startswith(f"# HELP {name} ") and lines[at + 1].startswith(name)
    bounds = [line.split('le="')[1].split('"')[0] for line in lines if "_bucket" in line]
    assert bounds == ["1.0", "5.0", "10.0", "30.0", "60.0", "120.0", "300.0", "600.0", "+Inf"]


def test_metrics_of_an_empty_log_are_zero(spark):
    samples = {r["metric"]: r["value"] for r in M.all_metrics(spark.createDataFrame([], _LOG)).collect()}
    assert samples == {"embed_requests_total": 0.0, "embed_errors_total": 0.0, "documents_skipped_total": 0.0}
    assert len(M.metrics_text(M.all_metrics(spark.createDataFrame([], _LOG))).collect()) == 2 * len(M.FAMILIES) + 3
