"""Delta-run tables: model-based checks, write cost, indexed lookups, several writers."""

import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.operators import runs as R
from corpusflow.operators import store as K
from corpusflow.plans.deltas import DeltaIngest
from corpusflow.session import ship_package

SCHEMA = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("chunk_id", T.IntegerType()), T.StructField("text", T.StringType())])
KEYS = ("doc_id", "chunk_id")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def put(table, rows, batch, gone=None, stream="batch"):
    state = table.log.load()
    run = table.write(frame(table.spark, rows) if rows else None, table.spark.createDataFrame([(g,) for g in gone], "doc_id string") if gone else None)
    return R.append(table.log, state, {table.name: run}, stream, batch)


def content(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[:2] for r in rows})
    return {r[:2]: r[2] for r in rows}


@pytest.fixture()
def table(spark, scratch):
    return R.RunTable(R.RunLog(spark, scratch), "t", SCHEMA, KEYS, file_rows=20)


def test_random_batches_equal_a_dictionary(spark, table):
    rng, model = random.Random(1), {}
    for batch in range(7):
        gone = rng.sample([f"d{k}" for k in range(12)], rng.choice([0, 0, 2]))
        rows = [(f"d{rng.randrange(12)}", c, f"{batch}-{c}") for c in range(rng.choice([0, 3, 30]))]
        rows = list({r[:2]: r for r in rows}.values())
        if not rows and not gone:
            continue
        assert put(table, rows, batch, gone)
        model = {k: v for k, v in model.items() if k[0] not in gone} | {r[:2]: r[2] for r in rows}  # a batch's own rows outlive its tombstones
        if batch % 2:
            table.compact()
        assert content(table.read()) == model
        ids = spark.createDataFrame([("d1",), ("d5",), ("none",), (None,)], "doc_id string")
        assert content(table.lookup(ids)) == {k: v for k, v in model.items() if k[0] in ("d1", "d5")}
    pairs = spark.createDataFrame([("d1", 0), ("d2", 1), ("d2", 1)], "doc_id string, chunk_id int")
    assert content(table.lookup(pairs)) == {k: v for k, v in model.items() if k in (("d1", 0), ("d2", 1))}
    assert put(table, [("d1", 0, "late")], 0) is None  # applied already


def test_empty_table_and_empty_batch(spark, table):
    assert table.read().collect() == [] and not table.compact()
    assert table.lookup(spark.createDataFrame([("a",)], "doc_id string")).collect() == []
    state = table.log.load()
    assert R.append(table.log, state, {"t": table.write(frame(spark, []))}, "batch", 0) is not None
    assert table.runs() == [] and table.read().collect() == []


def test_repeated_keys_raise_and_leave_nothing(spark, table):
    with pytest.raises(ValueError, match="repeats"):
        table.write(frame(spark, [("a", 0, "x"), ("a", 0, "y")]))
    assert table.log.versions() == []


def test_bytes_written_follow_the_batch(spark, table):
    put(table, [(f"d{k}", c, "some text " * 20) for k in range(400) for c in range(5)], 0)
    base = table.runs()[0]
    put(table, [(f"d{k}", 0, "new") for k in range(0, 400, 40)], 1)  # documents all over the table
    put(table, [], 2, gone=["d3"])
    small = table.runs()[1:]
    assert sum(r["bytes"] for r in small) < base["bytes"] / 5
    assert table.runs()[0]["id"] == base["id"]
    assert len(content(table.read())) == 2_000 - 5


def test_sizes_stay_geometric_and_old_runs_go(spark, table):
    for batch in range(9):
        put(table, [(f"d{batch}-{k}", 0, "x") for k in range(10)], batch)
        table.compact(ratio=2)
        sizes = [r["rows"] for r in table.runs()]
        assert all(sizes[k] >= 2 * sum(sizes[k + 1:]) for k in range(len(sizes) - 1))
    assert sum(sizes) == 90 and len(sizes) <= 4
    put(table, [("z", 0, "x")], 99)
    folders = {s.getPath().getName() for s in table.log.fs().listStatus(table.log.path("t"))}
    named = {r["id"] for v in table.log.versions() for r in table.log._read(v)["tables"].get("t", [])}
    assert folders == named


def test_lookup_opens_only_files_that_may_hold_a_key(spark, scratch):
    table = R.RunTable(R.RunLog(spark, scratch), "t", SCHEMA, KEYS, file_rows=50)
    put(table, [(f"d{k}", c, "x") for k in range(1_000) for c in range(2)], 0)
    put(table, [(f"e{k}", 0, "x") for k in range(1_000)], 1)
    files = len(table.read().inputFiles())
    found = table.lookup(spark.createDataFrame([("d7",), ("e9",), ("absent",)], "doc_id string"))
    assert files >= 60
    assert len(set(found.inputFiles())) <= 6
    assert content(found) == {("d7", 0): "x", ("d7", 1): "x", ("e9", 0): "x"}
    misses = table.candidates(spark.createDataFrame([(f"no{k}",) for k in range(300)], "doc_id string"))
    assert sum(map(len, misses.values())) <= 20  # false positives of the filters


def test_merge_on_read_leaves_the_old_run_in_place(spark, table):
    put(table, [(f"d{k}", 0, "x" * 50) for k in range(500)], 0)
    put(table, [("d1", 0, "y")], 1, gone=["d2"])
    df = table.read()
    assert len(df.collect()) == 499
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("Initial Plan")[0]


def _race(jobs):
    failed, gate = [], threading.Barrier(len(jobs))

    def run(job):
        try:
            gate.wait()
            job()
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=run, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed, failed


def test_two_writers_on_other_and_on_equal_keys_lose_nothing(spark, scratch):
    log = R.RunLog(spark, scratch)
    table = R.RunTable(log, "chunks", K.CHUNK_SCHEMA, K.CHUNK_KEYS)

    def batch(docs, text):
        return spark.createDataFrame([(d, 0, text, "s", "t") for d in docs], "doc_id string, chunk_id int, text string, source string, title string")

    def job(stream, k, docs, day):
        return lambda: R.upsert_chunk_run(table, batch(docs, f"{stream}{k}"), F.to_timestamp(F.lit(f"2026-01-0{day} 00:00:00")), k, stream)

    for k in range(3):  # different documents, then the same one
        _race([job("a", 2 * k, [f"a{k}"], 1), job("b", 2 * k, [f"b{k}"], 2)])
        _race([job("a", 2 * k + 1, ["same", f"x{k}"], 3), job("b", 2 * k + 1, ["same", f"x{k}"], 4)])
    rows = {r.doc_id: r for r in table.read().collect()}
    assert set(rows) == {"same", *(f"{x}{k}" for x in "abx" for k in range(3))}
    assert log.load()["applied"] == {"a": 5, "b": 5} and log.load()["version"] == 11
    for k in range(3):  # both saw the key: the second writer kept the first one's created_at
        last, first = ("a", 4) if rows[f"x{k}"].text.startswith("a") else ("b", 3)
        assert rows[f"x{k}"].created_at.day == first


def test_merge_beside_a_writer_and_unfinished_states(spark, table):
    for k in range(4):
        put(table, [(f"d{k}", 0, str(k))], k)
    _race([lambda: table.compact(ratio=8), lambda: put(table, [("late", 0, "x")], 9)])
    assert set(content(table.read())) == {("d0", 0), ("d1", 0), ("d2", 0), ("d3", 0), ("late", 0)}
    version = table.log.load()["version"] + 1
    out = table.log.fs().create(table.log.path(f"states/{R._STATE.format(version)}"), False)
    out.write(bytearray(b'{"version": '))  # a writer that died
    out.close()
    assert len(content(table.read())) == 5
    table.log.patience = 0.2
    with pytest.raises(RuntimeError, match="never finished"):
        put(table, [("after", 0, "x")], 10)


def test_delta_ingest_deletes_and_replays(spark, scratch):
    ship_package(spark)
    job = DeltaIngest(spark, scratch)
    docs = spark.createDataFrame([("hello world " * 200, "gdrive://a", "A"), ("short", "gdrive://b", "B"), ("", "gdrive://c", "C"), ("short", "gdrive://b", "B")],
                                 "text string, source string, title string")
    assert job.run(docs, 0) and not job.run(docs, 0)
    first = sorted(job.points().select("point_id", "vector").collect())
    assert job.run(docs, 1)
    assert sorted(job.points().select("point_id", "vector").collect()) == first
    assert job.chunks().count() == len(first) == 4
    ids = job.chunks().where("source = 'gdrive://a'").select("doc_id").distinct()
    assert job.delete_documents(ids, 2) and not job.delete_documents(ids, 2)
    assert job.chunks().count() == job.points().count() == 1
    assert job.run(docs, 3) and job.compact() and job.points().count() == 4


def test_a_task_writes_one_bucket(spark, table):
    """Buckets were hashed into tasks once more, so that several could meet in one."""
    run = table.write(frame(spark, [(f"d{k}", 0, "t") for k in range(300)]))
    files = table._rows(run, with_bucket=True).select("bucket", F.input_file_name().alias("file")).distinct().collect()
    tasks = {}
    for r in files:
        tasks.setdefault(r.file.split("part-")[1][:5], set()).add(r.bucket)
    assert run["buckets"] == 16 and len(files) == 16 and all(len(b) == 1 for b in tasks.values())
    assert R.FILE_ROWS <= 250_000
