"""Billing tables: the rows of their statements, built with little moved."""

import os

import pytest
from pyspark.sql import functions as F

from outledger import runtime, schemas
from outledger.testbed import adapter, catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver data not present")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_billing_tables_are_built_with_little_moved(spark):
    t = adapter.billing_tables(spark, FOLDER)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    scan = spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        for sql in (adapter.SQL["entry"], adapter.SQL["settled"], adapter.INVOICE, adapter.SQL["je_line"]):
            assert "Exchange" not in plan(t._made(sql))
        headers = t["invoice_line"].filter(F.col("inv_line_type") == "HEADER")
        assert "Exchange" not in plan(headers)
        assert "Exchange" not in plan(catalog.QUERIES["rate_rollup"].run(t))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", scan)


@pytest.mark.parametrize("name", ["je_line", "invoice_line"])
def test_tables_have_the_rows_of_their_statement(spark, name):
    t = adapter.billing_tables(spark, FOLDER)
    plain = {n: t[n] for n in adapter.DRIVER_TABLES}

    def made(n):
        if n not in plain:
            plain[n] = spark.sql(adapter.SQL[n], **{m: made(m) for m in adapter.needs(n)})
        return plain[n]

    expected = schemas.conform(made(name), name)
    assert t[name].columns == expected.columns or set(t[name].columns) == set(expected.columns)
    got = t[name].select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_lines_per_order_and_supplier_are_sums_of_stored_entries(spark):
    """`settled` is neither shuffled nor written: it reads `entry` and lies by invoice and relation as that does."""
    t = adapter.billing_tables(spark, FOLDER)
    assert all("/entry_" in file for file in t["settled"].inputFiles())
    plain = t._made(adapter.SQL["settled"])
    got = t["settled"].select(*plain.columns)
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    assert "Exchange" not in plan(t["settled"].groupBy("inv", "rel").count())


def test_folders_are_written_without_a_sort(spark):
    """The rows of a task go to open files, one per folder; a sort of wide rows spills."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    rows = spark.range(1000).selectExpr("id as k", "concat('t', id % 5) as kind", "id % 11 as v")
    seen = []

    class Seen(type(rows.write)):
        def saveAsTable(self, *args, **options):
            seen.append(spark.conf.get(name))
            return super().saveAsTable(*args, **options)

    writer = type(rows).write
    try:
        type(rows).write = property(lambda df: Seen(df))
        stored = runtime.bucketed(rows, "folders", ["k"], ["kind"])
    finally:
        type(rows).write = writer
    assert seen and int(seen[0]) >= 5 and spark.conf.get(name, "0") == before
    assert stored.select(*rows.columns).exceptAll(rows).count() == 0 and stored.count() == 1000
