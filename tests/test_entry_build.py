"""`entry` is moved without what follows from its other columns; `billed` is written for the invoice tables only."""

import os

import pytest
from pyspark.sql import functions as F

from outledger.testbed import adapter

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver data not present")


def test_entry_has_the_rows_of_its_statement_and_writes_no_billed(spark):
    t = adapter.Adapter(spark, FOLDER)
    got = t["entry"]
    assert "billed" not in t
    plain = spark.sql(adapter.SQL["billed"], lineitem=t["lineitem"], orders=t["orders"])
    expected = spark.sql(adapter.SQL["entry"], billed=plain)
    assert got.dtypes == expected.dtypes
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_entry_of_orders_with_two_rows(spark):
    """The least run and relation of a line are those of its least date and customer."""
    t = adapter.Adapter(spark, FOLDER)
    again = t["orders"].withColumns({"o_custkey": F.col("o_custkey") + 3, "o_orderdate": F.col("o_orderdate") - F.expr("interval 40 day")})
    t["orders"] = t["orders"].unionByName(again.filter("o_orderkey % 3 = 0"))
    plain = spark.sql(adapter.SQL["billed"], lineitem=t["lineitem"], orders=t["orders"])
    expected = spark.sql(adapter.SQL["entry"], billed=plain)
    got = t["entry"]
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_entry_moves_no_derived_column(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(adapter, "bucketed", lambda df, *args, **options: seen.append(df) or df)
    adapter.Adapter(spark, FOLDER)._entry()
    text = seen[0]._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    below = text.splitlines()[1]
    assert "ok#" in below and not [k for k in adapter.ENTRY_MADE if f" {k}#" in below or f"AS {k}#" in below]
