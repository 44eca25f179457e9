"""The tree data source (batch and stream), and the poll state with expiry."""

import os
import time

import pytest
from pyspark.sql import functions as F

from corpusflow.functions.text import glob_regex
from corpusflow.session import ship_package
from corpusflow.sources.trees import Folder, TreeReader, glob_pattern, register_tree_source


@pytest.fixture()
def tree(spark, tmp_path):
    ship_package(spark)
    register_tree_source(spark)
    files = {"a/docs/x.md": "one\r\ntwo", "a/docs/deep/er/y.TXT": "why", "a/src/z.py": "no", "b/readme.md": "b", "b/.hidden.md": "seen", "b/_u.rst": "under",
             "c/only.md": "c", "top.md": "top", "b/md": "no suffix", "b/.md": "only a suffix"}
    for path, text in files.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(text.encode())
    with open(tmp_path / "a/docs/huge.bin", "wb") as fh:  # sparse: 4 TB that no task could read
        fh.truncate(1 << 42)
    with open(tmp_path / "a/src/huge.md", "wb") as fh:
        fh.truncate(1 << 42)
    return str(tmp_path)


def found(df):
    return {r["path"]: bytes(r["content"]).decode() for r in df.collect()}


def test_unsupported_and_unmatched_files_are_never_opened(spark, tree):
    read = spark.read.format("corpus_tree")
    assert found(read.option("glob", "*/docs/**/*").load(tree)) == {"a/docs/x.md": "one\r\ntwo", "a/docs/deep/er/y.TXT": "why"}
    globs = '{"a": "docs/*", "b": "**/*.md"}'  # a component without a glob does not count
    assert set(found(spark.read.format("corpus_tree").option("globs", globs).load(f"file://{tree}"))) == {"a/docs/x.md", "b/readme.md", "b/.hidden.md"}
    one = spark.read.format("corpus_tree").option("suffixes", ".py").load(tree)
    assert set(found(one)) == {"a/src/z.py"}


def test_filters_on_the_path_decide_before_reading(spark, tree):
    df = spark.read.format("corpus_tree").load(tree)
    assert set(found(df.where(F.col("path").startswith("b/")))) == {"b/readme.md", "b/.hidden.md", "b/_u.rst"}
    assert set(found(df.where("path = 'top.md'"))) == {"top.md"}
    assert set(found(df.where("path in ('c/only.md', 'a/docs/huge.bin')"))) == {"c/only.md"}
    assert set(found(df.where("path like '%.rst' and length > 1"))) == {"b/_u.rst"}


def test_tasks_list_directories_the_driver_did_not(tree):
    wide = TreeReader({"path": tree, "partitions": "1"}).partitions()
    assert wide == [Folder(tree)]
    deep = TreeReader({"path": tree, "partitions": "3"}).partitions()
    assert {p.path.removeprefix(tree) for p in deep if isinstance(p, Folder)} == {"/a", "/b", "/c"}


def test_globs_equal_the_column_form(spark):
    globs = ["**/*", "*.md", "docs/**/*.md", "a?/[x]*", "**", "x.y/**", "en/*"]
    paths = ["a.md", "docs/a.md", "docs/x/y.md", "ab/[x]1", "x.y/z", "xzy/z", "en/q/r", "en/q", ""]
    rows = spark.createDataFrame([(g, p) for g in globs for p in paths], "g string, p string").withColumn("re", glob_regex("g"))
    for r in rows.selectExpr("g", "p", "regexp_like(p, re) as hit").collect():
        assert bool(glob_pattern(r["g"]).fullmatch(r["p"])) == r["hit"], r


def test_stream_gives_new_and_changed_files_once(spark, tmp_path, scratch):
    ship_package(spark)
    register_tree_source(spark)
    root = tmp_path / "in"
    (root / "d").mkdir(parents=True)
    for k in range(5):
        (root / f"d/{k}.md").write_text(f"v0 {k}")
        os.utime(root / f"d/{k}.md", ns=(0, 10**18 + k))
    stream = spark.readStream.format("corpus_tree").load(str(root))

    def poll():
        q = stream.selectExpr("path", "cast(content as string) as text").writeStream.format("parquet").option("path", f"{scratch}/out").option(
            "checkpointLocation", f"{scratch}/ckpt").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted(tuple(r) for r in spark.read.schema("path string, text string").parquet(f"{scratch}/out").collect())

    first = [(f"d/{k}.md", f"v0 {k}") for k in range(5)]
    assert poll() == first
    assert poll() == first  # a restart finds nothing new
    (root / "d/1.md").write_text("v1")
    os.utime(root / "d/1.md", ns=(0, 10**18 + 100))
    (root / "new.bin").write_text("not counted")
    assert poll() == sorted([*first, ("d/1.md", "v1")])


def test_files_that_are_no_longer_listed_leave_the_state(spark, scratch):
    from corpusflow.streaming.stateful import changed_files_stateful, state_snapshot

    schema = "file_id string, name string, modified_time string"

    def poll(rows, forget_after):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{scratch}/in")
        q = changed_files_stateful(spark.readStream.schema(schema).parquet(f"{scratch}/in"), None, forget_after).writeStream.format("parquet").option(
            "path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ckpt").outputMode("append").trigger(availableNow=True).start()
        assert q.awaitTermination(60)
        return spark.read.schema(schema).parquet(f"{scratch}/out").count()

    a, b = ("a", "a.md", "t0"), ("b", "b.md", "t0")
    assert poll([a, b], 8.0) == 2
    first = {tuple(r) for r in state_snapshot(spark, f"{scratch}/ckpt").collect()}
    assert first <= {("a", "t0"), ("b", "t0")}  # those whose time is not over
    time.sleep(9)
    assert poll([a], 8.0) == 3  # forgotten meanwhile: new again
    state = {r.file_id for r in state_snapshot(spark, f"{scratch}/ckpt").collect()}
    assert "b" not in state  # not listed, gone
