"""The queries that SQL can express, against DuckDB on the same tables."""

import os

import duckdb
import pytest

from vatio.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


def values(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{f}'")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert values([tuple(r) for r in got.collect()], got.columns) == values(want.fetchall(), columns)


def test_thirteen_operators_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
