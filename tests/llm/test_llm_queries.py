"""Registered queries against their SQL on the smallest driver data."""

import os

import duckdb
import pytest

from outledger.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver data not present")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query(llm, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    cursor = con.execute(queries.SQL[name])
    names = [d[0] for d in cursor.description]
    frame = queries.QUERIES[name](llm, FOLDER)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(repr(tuple(r[n] for n in names)) for r in frame.collect()) == sorted(map(repr, cursor.fetchall()))
