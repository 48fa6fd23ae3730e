"""Registered queries against DuckDB on the smallest driver data, and plan checks."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from outledger.testbed import adapter, catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in adapter.DRIVER_TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, name):
    frame = entry_point.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    expected = sorted(repr(r) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in frame.select(*names).collect()) == expected
    assert expected


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    t = adapter.billing_tables(spark, FOLDER)
    records = plan(catalog.QUERIES["outbound_lines"].run(t))
    for bad in ("CartesianProduct", "Python", "SortMergeJoin FullOuter"):
        assert bad not in records
    totals = plan(catalog.QUERIES["ar_total_per_invoice"].run(t))
    assert "(je_type#" in totals.split("PartitionFilters: ")[1].splitlines()[0]
    columns = totals.split("ReadSchema")[1].splitlines()[0]
    assert "billing_amt" in columns and "in_je_description" not in columns
    rollup = plan(catalog.QUERIES["rate_rollup"].run(t))
    assert "partial_sum" in rollup and "Not(EqualTo(inv_line_type,HEADER))" in rollup
