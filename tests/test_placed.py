"""Stored layouts, joins without gathering, and one-to-many joins as factors."""

import random
from collections import Counter
from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from billing import DAY, RUN, world
from outledger.operators import digest, journal, rollup
from outledger.operators.counterparty import counterparties
from outledger.operators.joins import dealt_join, hot_keys
from outledger.operators.pairs import PairView
from outledger.plans import outbound as job
from outledger.runtime import bucketed
from outledger.sources.files import write_outbound

P = job.Params("pop.site", "other.site")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def moved(frame):
    """Shuffles by hash or range in the plan; small tables sent to all tasks don't count."""
    return plan(frame).count("Exchange hashpartitioning") + plan(frame).count("Exchange rangepartitioning")


@pytest.fixture(scope="module")
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


CHARGES = [("US", n, 100 + n % 3, rate, "10", "1") for n in range(1, 9) for rate in ("0.1", "0.2")]


@pytest.fixture(scope="module")
def placed(rows):
    return job.place_tables(world(rows, CHARGES))


# ---------------------------------------------------------------- layouts


def test_placed_tables_are_joined_where_they_lie(placed, no_broadcast):
    digested = job.with_digest(placed, P)
    lines, picks = digested["je_line"], journal.representative_picks(digested, "REC")
    assert moved(digested["journal_digest"]) == 0 and moved(picks) == 0
    chosen = journal.picked_lines(digested, picks, "REC")
    assert moved(chosen) == 0
    assert moved(journal.vat_lines(placed, one_per_relation=True)) == 0
    picked = bucketed(chosen.select("invoice_prefix_seq_id", "billing_rel_id", "je_line_seq_id"), "p", job.PLACE)
    assert moved(picked.join(journal.vat_lines(placed, True), job.PLACE, "left")) == 0
    assert moved(rollup.rate_rollup(placed["invoice_line"], placed=True)) == 0
    for kind in ("REC", "VAT"):
        text = plan(lines.filter(F.col("je_type") == kind).groupBy("invoice_prefix_seq_id").count())
        assert text.count("FileScan") == 1 and f"(je_type#" in text.split("PartitionFilters: ")[1].splitlines()[0]


def test_job_on_placed_tables(rows, placed, no_broadcast):
    plain = job.outbound(world(rows, CHARGES), P)
    stored = job.outbound(placed, replace(P, placed=True))
    for name in ("records", "trailers", "rejects", "missing_contracts"):
        assert Counter(map(tuple, getattr(stored, name).collect())) == Counter(map(tuple, getattr(plain, name).collect()))
    made_of = job.prepare(placed, replace(P, placed=True))
    assert moved(made_of.numbered) == 0 and moved(made_of.relations) == 0


def test_digest_answers_what_the_lines_do(rows):
    t = world(rows, CHARGES)
    lines = t["je_line"]
    more = [
        lines.withColumn("je_line_seq_id", F.col("je_line_seq_id") + 1000 * k).withColumn("created_on", F.lit(when))
        .withColumn("shadow_ind", F.lit(shadow)).withColumn("brin_reference_id", F.lit(ref))
        for k, (when, shadow, ref) in enumerate([
            (DAY - timedelta(days=1), None, "REF0"), (DAY, "Y", "REF9"), (DAY + timedelta(days=2), "N", None),
            (DAY + timedelta(seconds=86399), "N", "REF5"),
        ], 1)
    ]
    for frame in more:
        lines = lines.unionByName(frame)
    t["je_line"] = lines.withColumn("brin_op_gl", F.when(F.col("je_line_seq_id") % 17 == 0, "CCA").otherwise("CCL"))
    found = {}
    for r in t["je_line"].collect():
        if r.je_type not in ("REC", "AR") or r.brin_op_gl != "CCL":
            continue
        key = (r.run_seq_id, r.invoice_prefix_seq_id, r.billing_rel_id, r.je_type, r.brin_reference_id)
        own = found.setdefault(key, [[], 0, 0, D(0)])
        open_ = r.shadow_ind in (None, "N")
        if open_ and abs(r.created_on - DAY) <= timedelta(days=1):
            own[0].append(r.je_line_seq_id)
        own[1] += open_
        own[2] += r.created_on.date() == DAY.date()
        own[3] += r.billing_amt
    expected = {k: (min(v[0], default=None), *v[1:], DAY) for k, v in found.items()}
    got = {tuple(r)[:5]: tuple(r)[5:] for r in digest.journal_digest(t, RUN).collect()}
    assert got == expected
    assert digest.journal_digest(t, RUN + 1).count() == 0


def test_same_run_is_checked(rows):
    t = world(rows, CHARGES)
    first = t["je_line"].filter("invoice_prefix_seq_id = 1")
    t["je_line"] = t["je_line"].unionByName(first.withColumn("run_seq_id", F.lit(RUN + 1).cast("long")))
    with pytest.raises(ValueError, match="invoice 1 of run 7"):
        job.outbound(t, replace(P, run=RUN, same_run=True))
    assert job.outbound(t, replace(P, run=RUN)).records.count()


def test_a_run_without_summary_writes_no_file(rows, tmp_path):
    t = world(rows, CHARGES)
    t["outbound_summary"] = t["outbound_summary"].limit(0)
    made = job.outbound(t, P)
    with pytest.raises(Exception, match="a run has no summary row"):
        write_outbound(made.records, made.trailers, "AR", date(2020, 5, 6), str(tmp_path / "out"))


# ---------------------------------------------------------------- dealt joins


def skewed(spark, n=9000):
    """A third of the rows on one key, a third without a key."""
    rng = random.Random(2)
    rows = [(k, 7 if k % 3 == 0 else None if k % 3 == 1 else rng.randint(100, 400), k % 5) for k in range(n)]
    right = [(k, f"v{k}") for k in [7, *range(100, 300)]] + [(7, "w7"), (None, "none")]
    return (
        spark.createDataFrame(rows, "id long, k long, kind long"), spark.createDataFrame(right, "other long, value string"), rows, right,
    )


def test_dealt_join_is_a_left_join(spark, no_broadcast):
    left, right, rows, right_rows = skewed(spark)
    values = {}
    for k, v in right_rows:
        values.setdefault(k, []).append(v)
    expected = Counter(
        (i, k, kind, k if v else None, v)
        for i, k, kind in rows for v in (values.get(k, [None]) if k is not None else [None])
    )
    hot = hot_keys(left, ["k"], 500)
    assert [tuple(r) for r in hot.collect()] == [(7, 6)]
    for found in (hot, None):
        got = dealt_join(left, right, {"k": "other"}, found, ["id"])
        assert Counter(map(tuple, got.collect())) == expected
    only = dealt_join(left, right, {"k": "other"}, hot, ["id"], F.col("kind") == 1)
    matched = Counter((i, v) for i, k, kind in rows for v in (values.get(k, [None]) if k is not None and kind == 1 else [None]))
    assert Counter((r.id, r.value) for r in only.collect()) == matched
    assert dealt_join(left.limit(0), right, {"k": "other"}, hot).count() == 0
    assert dealt_join(left, right.limit(0), {"k": "other"}, hot).filter("value is null").count() == len(rows)
    with pytest.raises(ValueError):
        dealt_join(left, left, {"k": "k"})


def test_dealt_join_spreads_hot_and_missing_keys(spark, no_broadcast):
    left, right, rows, _ = skewed(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest(frame):
            each = frame.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.countDistinct("id").alias("n"))
            return max(r.n for r in each.collect())

        plain = left.join(right, F.col("k") == F.col("other"), "left")
        dealt = dealt_join(left, right, {"k": "other"}, hot_keys(left, ["k"], 200), ["id"])
        assert largest(plain) > 0.3 * len(rows)
        assert largest(dealt) < 0.2 * len(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_two_keys_are_dealt_together(spark, no_broadcast):
    left, right, rows, right_rows = skewed(spark, 1200)
    right = right.withColumn("other_kind", F.lit(0).cast("long"))
    keys = {"k": "other", "kind": "other_kind"}
    got = dealt_join(left, right, keys, hot_keys(left, list(keys), 30), ["id"])
    plain = left.join(right, (F.col("k") == F.col("other")) & (F.col("kind") == F.col("other_kind")), "left")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))


# ---------------------------------------------------------------- factors


def test_pair_view_equals_the_pairs(spark):
    rng = random.Random(5)
    lines = [(k, rng.choice([1, 1, 1, 2, 3, None]), rng.choice("ab"), D(rng.randint(-50, 50))) for k in range(300)]
    members = [(k, rng.choice([1, 1, 2, 4, None]), f"f{k}", D(rng.randint(-9, 9)) if k % 7 else None) for k in range(100)]
    view = PairView(
        spark.createDataFrame(lines, "id long, k long, kind string, amt decimal(20,6)"),
        spark.createDataFrame(members, "m long, k long, fact string, vat decimal(20,6)"), ["k"], "m",
    )
    pairs = [(r.id, r.kind, r.amt, r.m, r.fact, r.vat) for r in view.expanded().collect()]
    rows = view.rows(("fact",), ("vat",)).collect()
    assert len(rows) == len(lines) < len(pairs) == sum(r.pairs for r in rows)
    for r in rows:
        own = sorted((p for p in pairs if p[0] == r.id), key=lambda p: p[3] or 0)
        assert r.pairs == len(own) and (r.m, r.fact) == own[0][3:5]
        assert r.members == sum(p[3] is not None for p in own)
        known = [p[5] for p in own if p[5] is not None]
        assert r.total_vat == (sum(known) if known else None)
    totals = {r.kind: r for r in view.totals(["kind"], ("amt",), ("vat",)).collect()}
    for kind in "ab":
        own = [p for p in pairs if p[1] == kind]
        assert totals[kind].pairs == len(own) and totals[kind].amt == sum(p[2] for p in own)
        assert totals[kind].vat == sum(p[5] for p in own if p[5] is not None)


def test_journal_has_one_row_per_line(rows):
    t = world(rows, CHARGES)
    vat = t["je_line"].filter("je_type = 'VAT'").withColumn("je_line_seq_id", F.col("je_line_seq_id") + 500)
    header = t["invoice_line"].filter("inv_line_type = 'HEADER' and invoice_prefix_seq_id = 3")
    t |= {"je_line": t["je_line"].unionByName(vat), "invoice_line": t["invoice_line"].unionByName(header)}
    cp = counterparties(t)
    whole = Counter(r.je_line_seq_id for r in journal.outbound_journal(t, cp, "p", "o", expanded=True).collect())
    folded = journal.outbound_journal(t, cp, "p", "o").collect()
    assert {r.je_line_seq_id: r.view_rows for r in folded} == whole and len(folded) == len(whole)
    assert {r.view_rows for r in folded} == {2, 4}
