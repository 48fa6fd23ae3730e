"""Registered views give all rows of their joins."""

import os
import re
from collections import Counter

import duckdb
import pytest

from outledger.testbed import adapter, catalog, checks

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in adapter.DRIVER_TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", ["conditional_on_left_join", "self_join_vat_line", "outbound_journal"])
def test_every_pair_of_the_view_is_a_row(spark, duck, name):
    block = "{v}" if name != "self_join_vat_line" else """(from {je_line} where je_type = 'REC') left join {vat_lines}
        using (invoice_prefix_seq_id, billing_rel_id)"""
    pairs = duck.execute(checks.with_blocks(f"select je_line_seq_id, vat_line_seq_id from {block}")).fetchall()
    found = catalog.spark_query(name)(spark, FOLDER).select("je_line_seq_id", "vat_line_seq_id").collect()
    assert Counter(map(tuple, found)) == Counter(pairs)
    assert max(Counter(r[0] for r in pairs).values()) > 1


def test_lines_move_once_for_invoice_and_relation_facts(spark):
    """Rows with a line's account aren't shuffled by the relation alone, nor by the invoice alone."""
    t = adapter.billing_tables(spark, FOLDER)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "500"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        lines = catalog._journal(t)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    moved = [lines[n + 1] for n, line in enumerate(lines) if re.search(
        r"Exchange hashpartitioning\((billing_rel_id|invoice_prefix_seq_id)#\d+L, \d+\)", line)]
    assert moved and not [line for line in moved if re.search(r"\bgl_account#", line)]
