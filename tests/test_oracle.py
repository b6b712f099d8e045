"""Every registered query against its DuckDB oracle on sf0.001."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from vatio.registry import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "top_tecnologia" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        pytest.fail("no oracle")
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    types = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    otypes = {r[0]: r[1] for r in con.execute(f"SELECT column_name, column_type FROM (DESCRIBE {ORACLE[name]})").fetchall()}
    assert {c: types.get(t, t) for c, t in df.dtypes} == otypes
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, ocols)
