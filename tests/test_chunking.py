"""The recursive splitter.

``naive_split`` below is a second, independent restatement of the public
splitter contract that works on strings (not offsets), used as brute force.
"""

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.functions.chunking import chunk_documents, chunk_spans, chunk_text

SEPS = ["\n\n", "\n", ". ", " ", ""]


def naive_split(text, size, overlap, seps=SEPS):
    def split_keep(t, sep):
        if sep == "":
            return list(t)
        parts = t.split(sep)
        out = [parts[0]] + [sep + p for p in parts[1:]]
        return [p for p in out if p != ""]

    def merge(pieces):
        docs, cur, total = [], [], 0
        for p in pieces:
            if total + len(p) > size and cur:
                d = "".join(cur).strip()
                if d:
                    docs.append(d)
                while total > overlap or (total + len(p) > size and total > 0):
                    total -= len(cur[0])
                    cur = cur[1:]
            cur.append(p)
            total += len(p)
        d = "".join(cur).strip()
        if d:
            docs.append(d)
        return docs

    def rec(t, seps):
        sep, rest = seps[-1], []
        for i, s in enumerate(seps):
            if s == "":
                sep = ""
                break
            if s in t:
                sep, rest = s, seps[i + 1:]
                break
        out, good = [], []
        for p in split_keep(t, sep):
            if len(p) < size:
                good.append(p)
            else:
                if good:
                    out += merge(good)
                    good = []
                if rest:
                    out += rec(p, rest)
                else:
                    out.append(p)
        if good:
            out += merge(good)
        return out

    return [c for c in rec(text, seps) if c.strip()]


# -- golden cases (shapes of the reference's own tests) ------------------------------------------

def test_short_text_is_one_unchanged_chunk():
    assert chunk_text("Hello world.", 1024, 128) == ["Hello world."]


def test_neighbours_overlap():
    text = "Word " * 500
    chunks = chunk_text(text, 256, 32)
    assert len(chunks) > 1
    for a, b in zip(chunks, chunks[1:]):
        assert a[-20:].split()[-1] in b[:64]


def test_sentences_with_overlap():
    text = " ".join(f"Sentence number {i} is here." for i in range(50))
    chunks = chunk_text(text, 200, 50)
    assert len(chunks) > 1 and all(len(c) <= 200 for c in chunks)


def test_empty_and_whitespace_give_no_chunks():
    assert chunk_text("", 256, 32) == []
    assert chunk_text("   \n\n  \t ", 256, 32) == []


def test_chunks_never_exceed_size():
    chunks = chunk_text("Word " * 1000, 512, 64)
    assert chunks and all(len(c) <= 512 for c in chunks)


def test_overlap_larger_than_size_is_an_error():
    with pytest.raises(ValueError):
        chunk_spans("abc", 10, 11)


def test_character_windows_step():
    text = "x" * 2500
    assert [len(c) for c in chunk_text(text, 1024, 128)] == [1024, 1024, 708]


# -- properties -------------------------------------------------------------------------------------

texts = st.text(alphabet="ab c.\n\t é", min_size=0, max_size=600)


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(min_value=2, max_value=80), st.integers(min_value=0, max_value=40))
def test_matches_naive_restatement(text, size, overlap):
    overlap = min(overlap, size)
    assert chunk_text(text, size, overlap) == naive_split(text, size, overlap)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=3000), st.integers(min_value=8, max_value=300))
def test_chunks_are_substrings_within_size(text, size):
    overlap = size // 8
    for b, e in chunk_spans(text, size, overlap):
        c = text[b:e]
        assert c.strip() == c and c
        assert e - b <= size or " " not in c


def test_corpus_anchor_and_brute_force():
    rows = duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' ORDER BY doc_id").fetchall()
    total = 0
    for (t,) in rows[:300]:
        got = chunk_text(t)
        assert got == naive_split(t, 1024, 128)
    for (t,) in rows:
        total += len(chunk_spans(t))
    assert total == 3462


def test_spark_stage_equals_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {}
    for r in chunk_documents(df, "text").collect():
        got.setdefault(r["doc_id"], []).append((r["chunk_id"], r["chunk_text"]))
    for r in df.collect():
        want = chunk_text(r["text"])
        have = [t for _, t in sorted(got.get(r["doc_id"], []))]
        assert have == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab c.\n\t é", min_size=0, max_size=400), min_size=1, max_size=8),
       st.integers(min_value=8, max_value=60), st.integers(min_value=0, max_value=20))
def test_sql_twin_of_the_splitter(texts, size, overlap):
    """The DuckDB splitter used by the oracle agrees with the Python splitter."""
    from corpusflow.plans.oracle_chunks import chunk_sql

    overlap = min(overlap, size)
    con = duckdb.connect()
    con.execute("CREATE TABLE d (key INTEGER, t VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?)", list(enumerate(texts)))
    got = {}
    for k, c, t in con.execute(chunk_sql("SELECT key, t FROM d", size, overlap)).fetchall():
        got.setdefault(k, {})[c] = t
    for k, t in enumerate(texts):
        have = [got.get(k, {})[i] for i in range(len(got.get(k, {})))]
        assert have == chunk_text(t, size, overlap)


def test_cutting_grows_with_the_length_of_the_document(spark):
    import time

    from pyspark.sql import functions as F

    def seconds(words):
        df = spark.range(1).select(F.repeat(F.lit("wörd and more. "), words).alias("text"))
        t = time.perf_counter()
        chunk_documents(df).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    seconds(1000)
    one, four = min(seconds(70_000) for _ in range(3)), min(seconds(280_000) for _ in range(3))  # 1 and 4 MB
    assert four < 6 * one


def test_workers_take_batches_in_pieces(spark, monkeypatch):
    import pyarrow as pa

    from corpusflow.functions.batches import pieces
    from corpusflow.functions.chunking import _chunk_udf, chunk_text
    from corpusflow.functions.constants import CHUNK_SEPARATORS
    from corpusflow.functions.embedding import CACHED, HashingEmbedder, _embed_udf
    from corpusflow.functions.html import _text_udf

    texts = [("word " * 3000 + f"\n\n{k}") if k % 7 else (None, "", " ")[k % 3] for k in range(400)]
    parts = list(pieces(pa.array(texts)))
    assert len(parts) > 2 and [t for p in parts for t in p] == texts
    batch = pa.array(texts)
    for udf in (_chunk_udf(1024, 128, CHUNK_SEPARATORS), _embed_udf("hashing", 64, 16), _text_udf("\n")):
        out = list(udf.func(iter([batch])))
        assert len(out) > 1 and sum(map(len, out)) == len(texts)
    cut = [c for a in _chunk_udf(1024, 128, CHUNK_SEPARATORS).func(iter([batch])) for c in a.to_pylist()]
    assert cut == [chunk_text(t) for t in texts]
    model = HashingEmbedder()
    model.embed([" ".join(f"w{k}" for k in range(CACHED + 10)) + " " + "x" * 1000])
    assert len(model._cache) <= CACHED and "x" * 1000 not in model._cache
