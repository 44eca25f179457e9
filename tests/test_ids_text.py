"""F1-F6, F11, F12, S3 against Python's own definitions."""

import hashlib
import uuid
from pathlib import PurePosixPath

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import ids
from corpusflow.functions import text as TX


def _py_source_type(s):
    if s.startswith("gdrive://"):
        return "drive"
    if s.startswith("http://") or s.startswith("https://"):
        return "git" if "@" in s.split("//", 1)[1] else "web"
    return "git"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=40), min_size=1, max_size=30))
def test_doc_id_and_point_id_match_stdlib(spark, sources):
    df = spark.createDataFrame([(s, i) for i, s in enumerate(sources)], "source string, chunk int")
    rows = df.select("source", "chunk", ids.doc_id("source").alias("d")).withColumn(
        "p", ids.point_id("d", "chunk")
    ).collect()
    for r in rows:
        d = str(uuid.uuid5(uuid.NAMESPACE_URL, r["source"]))
        assert r["d"] == d
        assert int(r["p"]) == int(hashlib.sha256(f"{d}:{r['chunk']}".encode()).hexdigest()[:16], 16)


def test_point_id_above_signed_range(spark):
    # find a key whose id needs the unsigned range
    for i in range(64):
        v = int(hashlib.sha256(f"doc-abc:{i}".encode()).hexdigest()[:16], 16)
        if v >= 2**63:
            got = spark.range(1).select(ids.point_id(F.lit("doc-abc"), F.lit(i)).alias("p")).first()["p"]
            assert int(got) == v
            return
    raise AssertionError("no large id found")


def test_ids_deterministic_and_distinct(spark):
    df = spark.createDataFrame([("doc-abc", 0), ("doc-abc", 1), ("doc-xyz", 0)], "d string, c int")
    ps = [r["p"] for r in df.select(ids.point_id("d", "c").alias("p")).collect()]
    assert len(set(ps)) == 3


NAMES = ["a.tar.gz", ".bashrc", "a.", "..", "readme.md", "x", "dir/file.TXT", "a..b", ".a.b"]


def test_stem_suffix_like_pathlib(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    rows = df.select("n", TX.stem(TX.file_name("n")).alias("s"), TX.suffix(TX.file_name("n")).alias("x")).collect()
    for r in rows:
        p = PurePosixPath(r["n"])
        assert (r["s"], r["x"]) == (p.stem, p.suffix), r["n"]


SOURCES = [
    "gdrive://x.pdf", "https://git.example.org/r.git@docs/a.md", "https://example.com/p", "http://a/@user",
    "ftp://host/x", "repo@path", "HTTPS://example.com", "https://user@host/x",
]


def test_source_type(spark):
    df = spark.createDataFrame([(s,) for s in SOURCES], "s string")
    for r in df.select("s", TX.source_type("s").alias("t")).collect():
        assert r["t"] == _py_source_type(r["s"]), r["s"]


def test_repo_name(spark):
    urls = ["https://github.com/a/b.git", "https://github.com/a/b/", "https://x/a.github.git", "https://x/y//", "plain"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    for r in df.select("u", TX.repo_name("u").alias("n")).collect():
        assert r["n"] == r["u"].rstrip("/").split("/")[-1].replace(".git", "")


def test_folder_id_from_url(spark):
    cases = {
        "https://drive.google.com/drive/folders/AbC_1-2?usp=sharing": "AbC_1-2",
        "AbC_1-2": "AbC_1-2",
        "https://drive.google.com/drive/u/0/my-drive": "https://drive.google.com/drive/u/0/my-drive",
    }
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    for r in df.select("u", TX.folder_id_from_url("u").alias("f")).collect():
        assert r["f"] == cases[r["u"]]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_py_strip_and_blank(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for r in df.select("v", TX.py_strip("v").alias("s"), TX.is_blank("v").alias("b")).collect():
        assert r["s"] == r["v"].strip()
        assert r["b"] == (r["v"].strip() == "")


def test_decode_text_like_python(spark):
    raw = [b"ab\xff", b"\xe2\x82 end", b"a\r\nb\rc\n", "é".encode()]
    df = spark.createDataFrame([(bytearray(b),) for b in raw], "c binary")
    got = [r["t"] for r in df.select(TX.decode_text("c").alias("t")).collect()]
    want = [b.decode("utf-8", errors="replace").replace("\r\n", "\n").replace("\r", "\n") for b in raw]
    assert got == want


def test_glob_regex(spark):
    import re

    cases = [("**/*.md", "a/b/c.md", True), ("**/*.md", "c.md", True), ("*.md", "a/c.md", False), ("en/*", "en/x.rst", True),
             ("en/*", "en/a/x.rst", False), ("docs/**/*", "docs/a/b.txt", True), ("a?.txt", "ab.txt", True)]
    df = spark.createDataFrame([(g,) for g, _, _ in cases], "g string")
    pats = [r["r"] for r in df.select(TX.glob_regex("g").alias("r")).collect()]
    for (g, path, ok), p in zip(cases, pats):
        assert bool(re.match(p, path)) == ok, (g, path, p)


def test_py_strip_is_linear_on_long_whitespace_runs(spark):
    import time

    s = "  a" + (" " * 100000) + "b \t"
    df = spark.createDataFrame([(s,)], "x string")
    t0 = time.time()
    assert df.select(TX.py_strip("x").alias("y")).first()["y"] == s.strip()
    assert time.time() - t0 < 30  # the quadratic form needs minutes here
