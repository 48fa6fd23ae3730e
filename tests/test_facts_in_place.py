"""Facts come to the lines: what the view and the job look up doesn't move the lines themselves."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from billing import world
from outledger.operators import branches, journal
from outledger.operators.counterparty import counterparties
from outledger.plans import outbound as job
from outledger.runtime import bucketed

CHARGES = [("US", n, 100 + n % 3, rate, "10", "1") for n in range(1, 9) for rate in ("0.1", "0.2")]


@pytest.fixture(scope="module")
def placed(spark, rows):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "1000"}
    before = {n: spark.conf.get(n) for n in names}
    for n, value in names.items():
        spark.conf.set(n, value)
    yield job.place_tables(world(rows, CHARGES))
    for n, value in before.items():
        spark.conf.set(n, value)


def shuffled_columns(frame):
    """What lies directly below a shuffle, as text."""
    lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    return [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]


def test_lines_of_the_view_are_not_moved(placed):
    """Small tables are sent to the lines; the lookups of origin, invoice and relation leave them where they are."""
    lines = bucketed(journal.outbound_lines(placed), "seen", job.PLACE)
    small = {"gl_account", "cost_center", "service"}
    t = {n: F.broadcast(placed[n].distinct()) if n in small else placed[n] for n in placed}
    found = journal.with_origin(lines, journal.line_origins(lines, journal.as_role(journal.source_lines(t), "origin"), None))
    met = found.join(journal.vat_lines(t, one_per_relation=True), job.PLACE, "left")
    below = shuffled_columns(met)
    assert below and not [text for text in below if "project#" in text or "billing_amt#" in text]
    view = journal.enrich(lines, t, counterparties(t), "p", "o", one_vat_line=True, hot_rows=None)
    moved = [text for text in shuffled_columns(view) if "project#" in text]
    assert all("_part#" in text for text in moved) and len(moved) <= len(small)


def test_a_crowded_relation_gives_the_same_facts(placed, monkeypatch):
    """Also for lines that share a number, and for a line without one."""
    t = dict(placed)
    lines = t["je_line"]
    twin = lines.filter("je_type = 'REC'").withColumn("gl_account", F.lit("4020601650"))
    bare = lines.filter("je_type = 'TP' or je_type = 'AR'").withColumn("je_line_seq_id", F.lit(None).cast("long"))
    t["je_line"] = lines.unionByName(twin).unionByName(bare)
    cp = counterparties(t)
    found = []
    for crowded in (journal.CROWDED, 1):
        monkeypatch.setattr(journal, "CROWDED", crowded)
        view = journal.outbound_journal(t, cp, "p", "o")
        found.append(Counter(map(tuple, view.select("je_line_seq_id", "expense_account", "tp_required", "orig_gl_account").collect())))
    assert found[0] == found[1]
    assert sum(found[0].values()) == journal.outbound_lines(t).join(cp, "billing_rel_id", "left_semi").count()


def test_the_highest_company_code_of_a_segment_counts(spark):
    lines = spark.createDataFrame([(1, "BUYER", "LONGSEG", "x")], "je_line_seq_id long, outbound_id string, s_bal_seg string, b_bal_seg string")
    codes = spark.createDataFrame([("LONGSEG", "C1"), ("LONGSEG", "C7"), ("LONGSEG", "C3")], "balancing_segment string, company_code string")
    assert [r.company_code for r in branches.with_company(lines, codes).collect()] == ["C7"]
