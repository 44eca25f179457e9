"""Keyed-table semantics on small frames, and snapshot replay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import joins as J
from corpusflow.operators import store as K
from corpusflow.operators.aggregates import last_wins


def _now():
    return F.lit(dt.datetime(2026, 1, 1)).cast("timestamp")


T0 = dt.datetime(2024, 1, 1)
CH = "doc_id string, chunk_id int, text string, source string, title string, created_at timestamp"


def _chunks(spark, rows):
    return spark.createDataFrame(rows, CH)


def test_upsert_overwrites_keeps_created_at_and_others(spark):
    old = _chunks(spark, [("d1", 0, "a", "s", "t", T0), ("d1", 1, "b", "s", "t", T0), ("d2", 0, "c", "s", "t", T0)])
    batch = spark.createDataFrame(
        [("d1", 0, "A", "s2", None, 0), ("d1", 0, "A2", "s2", "T", 1), ("d3", 0, "n", "s", "", 0)],
        "doc_id string, chunk_id int, text string, source string, title string, seq int",
    )
    got = {(r["doc_id"], r["chunk_id"]): r for r in K.upsert_chunks(old, batch, _now()).collect()}
    assert got[("d1", 0)]["text"] == "A2" and got[("d1", 0)]["title"] == "T" and got[("d1", 0)]["created_at"] == T0
    assert got[("d1", 1)]["text"] == "b"
    assert got[("d3", 0)]["created_at"] == dt.datetime(2026, 1, 1)
    assert len(got) == 4


def test_delete_touches_one_document(spark):
    old = _chunks(spark, [("d1", 0, "a", "s", "t", T0), ("d1", 1, "b", "s", "t", T0), ("d2", 0, "c", "s", "t", T0)])
    left = K.delete_docs(old, spark.createDataFrame([("d1",)], "doc_id string")).collect()
    assert [(r["doc_id"], r["chunk_id"]) for r in left] == [("d2", 0)]


def test_hydrate_and_get_chunk(spark):
    old = _chunks(spark, [("d1", 0, "a", "s", "t", T0), ("d1", 1, "b", "s", "t", T0), ("d2", 0, "c", "s", "t", T0)])
    refs = spark.createDataFrame([("d1", 0), ("d1", 0), ("d9", 0), ("d2", 0)], "doc_id string, chunk_id int")
    got = sorted((r["doc_id"], r["chunk_id"], r["text"]) for r in J.hydrate_chunks(refs, old).collect())
    assert got == [("d1", 0, "a"), ("d2", 0, "c")]
    assert J.hydrate_chunks(refs.limit(0), old).count() == 0
    assert J.get_chunk(old, "d1", 1).first()["text"] == "b"
    assert J.get_chunk(old, "d1", 7).first() is None


def test_state_change_detection(spark):
    listing = spark.createDataFrame(
        [("f1", "a.md", "x", "2026-01-01T00:00:00Z"), ("f2", "b.md", "x", "2026-01-02T00:00:00Z"), ("f3", "c.md", "x", "t")],
        "file_id string, name string, mime string, modified_time string",
    )
    state = spark.createDataFrame([("f1", "2026-01-01T00:00:00Z"), ("f2", "old"), ("gone", "t")], "file_id string, modified_time string")
    changed = sorted(r["file_id"] for r in J.changed_files(listing, state).collect())
    assert changed == ["f2", "f3"]
    assert sorted(r["file_id"] for r in J.prune_state(state, listing).collect()) == ["f1", "f2"]
    fetched = spark.createDataFrame([("f3", "t")], "file_id string, modified_time string")  # f2 failed
    adv = {r["file_id"]: r["modified_time"] for r in J.advance_state(state, listing, fetched).collect()}
    assert adv == {"f1": "2026-01-01T00:00:00Z", "f2": "old", "f3": "t"}


def test_attach_vectors_mismatch_raises(spark):
    import pytest

    chunks = spark.createDataFrame([("d", 0), ("d", 1)], "doc_id string, chunk_id int")
    vecs = spark.createDataFrame([("d", 0, [0.1, 0.2])], "doc_id string, chunk_id int, vector array<float>")
    with pytest.raises(Exception):
        J.attach_vectors(chunks, vecs).collect()
    ok = J.attach_vectors(chunks.limit(1), vecs).collect()
    assert len(ok) == 1


def test_last_wins_forms_agree(spark):
    from corpusflow.operators.aggregates import last_wins_window

    b = spark.createDataFrame([("k", 0, "a", 0), ("k", 0, "b", 1), ("j", 1, "c", 0)], "doc_id string, chunk_id int, text string, seq int")
    a1 = sorted(tuple(r) for r in last_wins(b, ("doc_id", "chunk_id")).select("doc_id", "chunk_id", "text").collect())
    a2 = sorted(tuple(r) for r in last_wins_window(b, ("doc_id", "chunk_id")).select("doc_id", "chunk_id", "text").collect())
    assert a1 == a2 == [("j", 1, "c"), ("k", 0, "b")]


def test_register_collections_merges_types(spark):
    reg = spark.createDataFrame([("docs", ["drive"], T0)], "name string, source_types array<string>, updated_at timestamp")
    batch = spark.createDataFrame([("docs", ["web", "drive"]), ("new", ["git"])], "name string, source_types array<string>")
    got = {r["name"]: r["source_types"] for r in K.register_collections(reg, batch, _now()).collect()}
    assert got == {"docs": ["drive", "web"], "new": ["git"]}


def test_ensure_schema_migrates_text_created_at(spark):
    legacy = spark.createDataFrame(
        [("d", 0, "x", "2024-05-01T10:00:00Z"), ("d", 1, "y", ""), ("d", 2, "z", None)],
        "doc_id string, chunk_id int, text string, created_at string",
    )
    rows = {r["chunk_id"]: r for r in K.ensure_chunk_schema(legacy).collect()}
    assert rows[0]["created_at"] == dt.datetime(2024, 5, 1, 10) and rows[1]["created_at"] == dt.datetime(1970, 1, 1)
    assert rows[2]["title"] == "" and rows[2]["source"] == ""


def test_snapshot_replay_is_noop(spark, scratch):
    t = K.SnapshotTable(spark, scratch, K.CHUNK_SCHEMA)
    assert t.read().count() == 0
    df = _chunks(spark, [("d1", 0, "a", "s", "t", T0)])
    t.write(df, 0)
    t.write(K.upsert_chunks(t.read(before=1), df, _now(), seq=None), 1)
    assert t.current_version() == 1
    assert sorted(map(tuple, t.read().collect())) == sorted(map(tuple, df.collect()))


def test_keyed_table_rewrites_only_touched_buckets(spark, scratch):
    import os

    t = K.KeyedTable(spark, scratch, K.CHUNK_SCHEMA, "doc_id", buckets=8)
    rows = [(f"d{i}", c, f"t{i}-{c}", "s", "t", T0) for i in range(40) for c in range(3)]
    merge = lambda old, b: K.upsert_chunks(old, b, _now(), seq=None)
    assert t.upsert(_chunks(spark, rows), merge, 0)
    before = t._state()["current"]
    one = _chunks(spark, [("d7", 0, "new", "s", "t", T0), ("d99", 0, "fresh", "s", "t", T0)])
    assert t.upsert(one, merge, 1)
    assert not t.upsert(one, merge, 1)  # replay of a committed batch
    after = t._state()["current"]
    changed = {b for b in after if after[b] != before.get(b)}
    assert changed == {str(b) for b in t.touched(one)}
    got = {(r["doc_id"], r["chunk_id"]): r["text"] for r in t.read().collect()}
    assert len(got) == 121 and got[("d7", 0)] == "new" and got[("d7", 1)] == "t7-1" and got[("d99", 0)] == "fresh"


def _merge(old, b):
    return K.upsert_chunks(old, b, _now(), seq=None)


def test_keyed_table_keeps_its_bucket_count(spark, scratch):
    import pytest

    rows = _chunks(spark, [(f"d{i}", 0, f"t{i}", "s", "t", T0) for i in range(40)])
    K.KeyedTable(spark, scratch, K.CHUNK_SCHEMA, "doc_id", buckets=8).upsert(rows, _merge, 0)
    with pytest.raises(ValueError):
        K.KeyedTable(spark, scratch, K.CHUNK_SCHEMA, "doc_id", buckets=4)
    t = K.KeyedTable(spark, scratch, K.CHUNK_SCHEMA, "doc_id")
    assert t.buckets == 8
    t.rebucket(3)
    t = K.KeyedTable(spark, scratch, K.CHUNK_SCHEMA, "doc_id", buckets=3)
    t.upsert(rows, _merge, 1)
    assert t.read().count() == 40 and len(t._state()["current"]) <= 3


def test_keyed_table_lookup_reads_the_buckets_of_its_keys(spark, scratch):
    t = K.KeyedTable(spark, scratch, K.CHUNK_SCHEMA, "doc_id", buckets=16)
    t.upsert(_chunks(spark, [(f"d{i}", c, f"t{i}-{c}", "s", "t", T0) for i in range(30) for c in (0, 1)]), _merge, 0)
    found = t.lookup(spark.createDataFrame([("d3", 1), ("d3", 1), ("nope", 0)], "doc_id string, chunk_id int"))
    assert [r["text"] for r in found.collect()] == ["t3-1"]
    assert {f.split("bucket=")[1].split("/")[0] for f in t.read(t.touched(found)).inputFiles()} == {str(b) for b in t.touched(found)}


def test_a_crash_between_write_and_commit_leaves_the_table(spark, scratch):
    t = K.KeyedTable(spark, scratch, K.CHUNK_SCHEMA, "doc_id", buckets=2)
    t.upsert(_chunks(spark, [(f"d{i}", 0, "a", "s", "t", T0) for i in range(20)]), _merge, 0)
    batch = _chunks(spark, [("d1", 0, "b", "s", "t", T0)])
    t.stage(batch, _merge, 1)  # data written, never committed
    assert {r["text"] for r in t.read().collect()} == {"a"}
    assert t.upsert(batch, _merge, 1)
    assert sorted(r["text"] for r in t.read().collect()) == ["a"] * 19 + ["b"]


def test_old_versions_go_and_emptied_buckets_stay_empty(spark, scratch):
    t = K.KeyedTable(spark, scratch, K.CHUNK_SCHEMA, "doc_id", buckets=1)
    for i in range(6):
        t.upsert(_chunks(spark, [("d", 0, f"t{i}", "s", "t", T0)]), _merge, i)
    assert [r["text"] for r in t.read().collect()] == ["t5"]
    assert sorted(t.manifest.names("data")) == ["v=3", "v=4", "v=5"] and len(t.manifest.versions()) == 3
    t.delete(spark.createDataFrame([("d",)], "doc_id string"), 6)
    assert t.read().count() == 0


def test_repeated_batch_keys_raise(spark):
    import pytest

    old = _chunks(spark, [("d", 0, "a", "s", "t", T0)])
    with pytest.raises(Exception, match="repeated key"):
        K.upsert_chunks(old, _chunks(spark, [("d", 0, "b", "s", "t", T0), ("d", 0, "c", "s", "t", T0)]), _now(), seq=None).collect()


def _job(spark, scratch, **kw):
    from corpusflow.plans.ingest import IngestJob

    return IngestJob(spark, scratch, buckets=2, **kw)


def test_a_document_in_two_collections_has_one_row_per_chunk(spark, scratch):
    job = _job(spark, scratch)
    rows = [("body", "git://a", "t", c) for c in ("one", "two")] + [(f"n{i}", "git://b", "t", "one") for i in range(1)]
    for i in range(3):
        docs = spark.createDataFrame([*rows[:2], (f"neighbour {i}", "git://b", "t", "one")], "text string, source string, title string, collection string")
        job.run(docs, i)
        assert job.chunks().count() == 2 and job.points().count() == 3
    assert {r["text"] for r in job.chunks().collect()} == {"body", "neighbour 2"}


def test_the_last_of_colliding_sources_wins(spark, scratch):
    job = _job(spark, scratch)
    for i, seq in enumerate([(1, 2), (4, 3)]):
        docs = spark.createDataFrame([("one", "git://a", "t", seq[0]), ("two", "git://a", "t", seq[1])], "text string, source string, title string, seq int")
        job.run(docs, i)
        assert [r["text"] for r in job.chunks().collect()] == [["two"], ["one"]][i]


def test_streams_do_not_hide_each_others_batches(spark, scratch):
    job = _job(spark, scratch)
    for i, (stream, batch) in enumerate([("a", 0), ("b", 0), ("b", 1), ("a", 1)]):
        job.run(spark.createDataFrame([("x", f"git://{i}", "t")], "text string, source string, title string"), batch, stream=stream)
    assert job.chunks().count() == 4


def test_log_after_a_replay_and_after_a_failure(spark, scratch):
    import pytest

    from corpusflow.operators import metrics as M

    docs = spark.createDataFrame([("x", "git://a", "t"), ("y", "git://b", "t")], "text string, source string, title string")
    job = _job(spark, scratch)
    job.run(docs, 0)
    job.run(docs, 1)
    log = sorted(job.ingest_log().select("batch_id", "n_docs", "n_chunks", "skipped", "ok").collect())
    assert [tuple(r) for r in log] == [(0, 2, 2, 0, True), (1, 0, 0, 2, None)]
    job.model = "no such model"
    with pytest.raises(Exception):
        job.run(docs.withColumn("source", F.concat("source", F.lit("2"))), 2)
    assert job.chunks().count() == 2  # nothing of the failed batch is seen
    assert job.ingest_log().where("NOT ok").select("batch_id", "n_docs").collect() == [(2, 0)]
    values = {r["metric"]: r["value"] for r in M.counter_metrics(job.ingest_log()).collect()}
    assert 2.0 in values.values()


def test_micro_batches_are_the_same_for_every_partitioning(spark):
    from corpusflow.operators.aggregates import micro_batches, numbered

    df = spark.range(1003).selectExpr("id * 7 % 1003 as id")
    want = [(k, 100 if k < 10 else 3, str(100 * k)) for k in range(11)]
    for laid in (df.repartition(1), df.repartition(7), df.repartition(3, "id")):
        assert sorted(tuple(r) for r in micro_batches(laid, 100, "id").collect()) == want
    positions = numbered(df.repartition(5), "id").collect()
    assert all(r["position"] == r["id"] for r in positions) and len(positions) == 1003
    assert micro_batches(df.limit(0), 100, "id").collect() == []


def test_skip_stats_counts_chunks_without_a_document(spark):
    from corpusflow.operators.aggregates import skip_stats

    chunks = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "doc_id string")
    seen = spark.createDataFrame([("a",), ("a",), ("x",)], "doc_id string")
    assert tuple(skip_stats(chunks, seen).first()) == (5, 3, 2, 3, 1)
    assert tuple(skip_stats(chunks.limit(0), seen).first()) == (0, 0, 0, 0, 0)


def test_ensure_parallel_judges_without_running(spark, scratch):
    from corpusflow.session import ensure_parallel

    spark.range(1000).coalesce(1).write.parquet(scratch)
    small = spark.read.parquet(scratch)
    assert ensure_parallel(small).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    spark.range(1000).repartition(spark.sparkContext.defaultParallelism).write.parquet(scratch + "-many")
    many = spark.read.parquet(scratch + "-many")
    assert ensure_parallel(many) is many
    big = spark.range(10**9)
    assert ensure_parallel(big) is big
    failing = small.select(F.raise_error(F.lit("ran")).alias("x")).groupBy("x").count()
    ensure_parallel(failing)
