"""Stream equals batch; replays change nothing."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from corpusflow.plans.ingest import chunk_rows, prepare_documents
from corpusflow.sources.fixtures import Fixtures
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    streamed = E.queries()["ingest_stream"](spark, SF_SMALL)
    fx = Fixtures(spark, SF_SMALL)
    batch = chunk_rows(prepare_documents(fx.v_docs().select("text", "source", "title")))
    cols = ["doc_id", "chunk_id", "text", "source", "title"]
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert a == b


def test_replay_changes_nothing(spark):
    rows = {r["table"]: r for r in E.queries()["idempotent_replay"](spark, SF_SMALL).collect()}
    for r in rows.values():
        assert r["differing_rows"] == 0 and r["rows_first"] == r["rows_replayed"] > 0


def test_full_rerun_skips_vectors(spark):
    out = E.queries()["ingest_full"](spark, SF_SMALL).collect()
    fx = Fixtures(spark, SF_SMALL)
    n = chunk_rows(prepare_documents(fx.v_docs().select("text", "source", "title"))).count()
    assert sum(r["points"] for r in out) == n


def test_change_detection_stream_matches_batch(spark):
    from corpusflow.operators.joins import changed_files

    fx = Fixtures(spark, SF_SMALL)
    s = E.queries()["changed_files_stream"](spark, SF_SMALL)
    b = changed_files(fx.v_listing(), fx.v_state()).select("file_id", "name", "modified_time")
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, b.collect()))
    assert s.where(F.col("file_id").isNull()).count() == 0


def test_ingest_log_feeds_metrics(spark, scratch):
    from corpusflow.operators import metrics as M
    from corpusflow.plans.ingest import IngestJob

    fx = Fixtures(spark, SF_SMALL)
    job = IngestJob(spark, scratch)
    docs = fx.v_docs().select("text", "source", "title")
    job.run(docs, 0)
    job.run(docs, 1)
    log = job.ingest_log()
    by_batch = {r["batch_id"]: r for r in log.groupBy("batch_id").agg(F.sum("n_docs").alias("d"), F.sum("n_chunks").alias("c"), F.sum("skipped").alias("s")).collect()}
    n = job.chunks().count()
    assert by_batch[0]["c"] == n and by_batch[0]["s"] == 0
    assert by_batch[1]["c"] == 0 and by_batch[1]["s"] == n
    lines = [r["line"] for r in M.metrics_exposition(M.all_metrics(log)).collect()]
    assert any(line.startswith("chunks_created_total{collection=\"documents\"}") for line in lines)


def test_supervised_stream_replays_failed_batch(spark, scratch):
    from corpusflow.plans.ingest import IngestJob
    from corpusflow.streaming import jobs as T

    fx = Fixtures(spark, SF_SMALL)
    job = IngestJob(spark, f"{scratch}/tables")
    state = {"fail": True}

    def prepare(batch):
        if state["fail"]:  # first attempt of the first batch fails
            state["fail"] = False
            raise RuntimeError("embedding service unavailable")
        return fx.v_docs(batch).select("text", "source", "title")

    def start():
        stream = T.file_stream(spark, SF_SMALL, T.DOCUMENT_SCHEMA, file_glob="documents.parquet")
        return T.start_ingest_stream(stream, job, f"{scratch}/ckpt", {"availableNow": True}, prepare)

    T.supervise(start, max_restarts=2, wait_s=0.1, log=lambda m: None)
    n = chunk_rows(prepare_documents(fx.v_docs().select("text", "source", "title"))).count()
    assert job.chunks().count() == n and job.points().count() == n


def test_colliding_sources_keep_one_document(spark, scratch):
    from corpusflow.plans.ingest import IngestJob

    docs = spark.createDataFrame(
        [("alpha text. " * 200, "gdrive://same.md", "A"), ("beta words " * 300, "gdrive://same.md", "B"), ("solo", "gdrive://x.md", "")],
        "text string, source string, title string",
    )
    job = IngestJob(spark, scratch)
    job.run(docs, 0)
    ch = job.chunks()
    assert ch.groupBy("doc_id", "chunk_id").count().where("count > 1").count() == 0
    assert ch.select("title").distinct().count() == 2  # one of A/B survives whole, plus the solo document
    assert job.points().count() == ch.count()


def test_replace_docs_and_delete(spark, scratch):
    from corpusflow.plans.ingest import IngestJob

    long = spark.createDataFrame([("x " * 2000, "gdrive://a.md", "A"), ("keep me", "gdrive://b.md", "B")], "text string, source string, title string")
    short = spark.createDataFrame([("y " * 10, "gdrive://a.md", "A")], "text string, source string, title string")
    for replace, want in ((False, None), (True, 1)):
        job = IngestJob(spark, f"{scratch}/{replace}", replace_docs=replace)
        job.run(long, 0)
        n_a = job.chunks().where("title = 'A'").count()
        assert n_a > 1
        job.run(short, 1)
        after = job.chunks().where("title = 'A'").count()
        assert after == (want if replace else n_a)  # Q6: without replace the old high chunk ids stay
        ids = spark.createDataFrame(job.chunks().where("title = 'A'").select("doc_id").distinct().collect(), "doc_id string")
        job.delete_documents(job.chunks().where("title = 'A'"), 2)  # a frame over the table itself
        assert job.chunks().where("title = 'A'").count() == 0 and job.chunks().where("title = 'B'").count() == 1
        assert job.points().join(ids, "doc_id", "left_semi").count() == 0


def test_streams_read_a_table_of_several_files(spark, tmp_path):
    """Larger tables come as folders of Parquet files; the streams passed over all of those."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 60")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    sf, fx = str(tmp_path), Fixtures(spark, str(tmp_path))
    queries = E.queries()
    assert queries["stream_documents"](spark, sf).count() == docs.count()
    changed = {r[0] for r in queries["changed_files_stream"](spark, sf).select("file_id").collect()}
    assert changed and {r[0] for r in queries["changed_files_stateful"](spark, sf).select("file_id").collect()} == changed
    ids = fx.v_listing().select("file_id").union(fx.v_state().select("file_id")).distinct()
    assert queries["state_snapshot"](spark, sf).count() == ids.count()
    chunks = chunk_rows(prepare_documents(fx.v_docs().select("text", "source", "title"))).count()
    assert queries["ingest_stream"](spark, sf).count() == chunks


def test_stateful_processor_travels_without_the_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from corpusflow.streaming.stateful import LastModified

    (tmp_path / "processor").write_bytes(cloudpickle.dumps(LastModified(1.0)))
    code = "import pickle; print(pickle.load(open('processor', 'rb')).ttl)"
    env = {"PATH": "", "PYTHONPATH": ""}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=60)
    assert run.stdout == "1000\n", run.stderr


def test_replay_compares_every_column_without_moving_texts(spark, scratch):
    from corpusflow.plans.ingest import IngestJob
    from corpusflow.plans.q_stream import _told_apart

    docs = spark.createDataFrame([("one two", "gdrive://a.md", "A"), ("two three", "gdrive://b.md", "B")], "text string, source string, title string")
    job = IngestJob(spark, scratch)
    job.run(docs, 0, F.to_timestamp(F.lit("2026-01-01 00:00:00")))
    assert job.point_table.holds(job.point_table.touched(job.chunks()))
    first = {name: rows.checkpoint() for name, rows in _told_apart(job).items()}
    assert all({"text", "vector"}.isdisjoint(rows.columns) for rows in first.values())
    job.run(docs.withColumn("title", F.when(F.col("title") == "A", "C").otherwise(F.col("title"))), 1)
    after = _told_apart(job)
    assert first["chunks"].exceptAll(after["chunks"]).count() == 1 and first["points"].exceptAll(after["points"]).count() == 0
