"""Every registered query against its DuckDB oracle at sf0.001 (rows-only ones must run)."""

import datetime as dt
import decimal
import math

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SLOW = {"ingest_stream", "ingest_now", "ingest_full", "idempotent_replay", "stream_documents", "changed_files_stream"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, (float, np.floating)):
        return None if math.isnan(v) else round(float(v), 9)
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return int(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    c1, r1 = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    c2, r2 = _canon([d[0] for d in res.description], res.fetchall())
    assert c1 == c2
    assert r1 == r2


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"collection", "point_id", "doc_id", "chunk_id", "vector"}
    assert df.count() > 0


def test_every_inventory_operator_is_registered():
    from corpusflow.plans.registry import REGISTRY

    ops = {q.op for q in REGISTRY.values()}
    inventory = (
        [f"S{i}" for i in range(1, 9)] + [f"E{i}" for i in range(1, 11)] + [f"P{i}" for i in range(1, 7)]
        + [f"J{i}" for i in range(1, 9)] + [f"A{i}" for i in range(1, 11)] + ["W1", "W2", "W3", "O1", "O2", "U1", "U2", "U3"]
        + [f"F{i}" for i in range(1, 13)] + [f"K{i}" for i in range(1, 8)] + [f"T{i}" for i in range(1, 6)] + ["D1", "D2"]
    )
    assert set(inventory) <= ops, sorted(set(inventory) - ops)
