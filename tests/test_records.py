"""Records of hand-made invoices, column by column."""

import hashlib
import json
import random
from collections import Counter
from dataclasses import replace
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from billing import COUNTRIES, RUN, world
from outledger.plans import outbound as job
from outledger.plans.layout import comma_count
from outledger.runtime import materialize
from outledger.sources.files import with_line_numbers, write_outbound

P = job.Params("pop.site", "other.site")


def rel(country, n=1):
    return COUNTRIES[country] * 100 + n


CHARGES = [
    ("US", 1, rel("US"), "0.05", "-100.10", "-5.005"),
    *[("AR", 2, rel("AR", r), rate, "10", "1") for r in (2, 1) for rate in ("0.10", None, "0.05")],
    ("CN", 3, rel("CN"), "0.01", "250", "10"),
    ("CN", 3, rel("CN"), "0.02", "300", "10"),
    ("CN", 3, rel("CN", 2), "0.01", "50", "1"),
    ("IN", 4, rel("IN"), "0.15", "100.10", "15"),
    ("IN", 5, rel("IN"), "0.07", "100", "7"),
    ("CO", 6, rel("CO"), "0.19", "1000", "190"),
    ("RU", 7, rel("RU"), "0.2", "10", "2"),
    *[("MX", 20 + i, rel("MX"), "0.16", "10", "1.6") for i in range(8)],
]


@pytest.fixture(scope="module")
def tables(rows):
    extra = {"service": [dict(code="SV", sbx_commodity_code="HS1", is_active_ind="Y")]}
    return world(
        rows, CHARGES, cap="100", regime={"AR": "N"}, je={"service_code": "SV"}, extra=extra
    )


@pytest.fixture(scope="module")
def made_of(tables):
    return job.prepare(tables, P)


@pytest.fixture(scope="module")
def records(tables, made_of):
    return ordered(job.records_of(tables, made_of, P))


def ordered(df):
    return sorted(df.collect(), key=lambda r: (r.invoice_prefix_seq_id, r.line_start, r.seq))


def of(records, invoice, kind=None):
    return [
        r for r in records if r.invoice_prefix_seq_id == invoice and kind in (None, r.kind)
    ]


def cells(record):
    parts = record["line"].split(",")
    assert len(parts) == 96
    return {n: v for n, v in enumerate(parts, start=1) if v}


SHARED = {
    1: "BILCCL", 2: "CCLARINVES", 3: "20200504", 4: "20200504", 5: "NI-1", 6: "DERIVE",
    12: "USD", 13: "MOR", 14: "20200504", 16: "SITE", 19: "IMMEDIATE", 20: "BR",
    21: "Due upon receipt.  Please send payment directly to our bank. B-C IB",
    36: "CCLAR", 37: "BBUC", 43: "If questions please contact pop.site", 45: "SBUC", 48: "CT1",
    60: "CCLAR", 67: "ADN1", 77: "BAL1", 81: "000", 85: "P", 86: "000000000", 87: "000000",
}
FIRST = "2020-05-04|NI-1|POP-R1-03-K|SBUC|BBUC|AR|OTH|SS|TX|OOB"


def test_golden_default_country(records):
    rec, rev, tax = of(records, 1)
    text = {7: "CM", 52: "1", 54: "REF1 - Work- done", 61: "REF1 - Work- done"}
    assert cells(rec) == SHARED | text | {
        66: FIRST, 76: "REC", 78: "ACC1", 79: "SEG4", 80: "000000", 82: "PRJ",
        83: "000000", 84: "PL1", 88: "12.35",
    }
    long = f"{FIRST}|0.000|5.000|CC1|ORIG|a|b|c|d|mail|  f|g"
    assert cells(rev) == SHARED | text | {
        55: "-1", 56: "100.10", 57: "EA", 58: "5.000", 66: long, 76: "REV", 78: "ACC1",
        79: "SEG4", 80: "CC1", 82: "PRJ", 83: "REF1", 84: "PL1", 88: "-100.10",
    }
    assert cells(tax) == SHARED | text | {
        58: "5.000", 66: long, 76: "TAX", 78: "VATACC", 79: "0000", 80: "000000",
        82: "0000000000", 83: "000000", 84: "000000", 88: "-5.01",
    }


def test_line_numbers_run_across_relations(records):
    got = of(records, 2)
    assert {cells(r)[13] for r in got} == {"ARBANK_DAILY"}
    assert [r.kind for r in got] == ["REC"] + ["REV"] * 6
    assert [(r.billing_rel_id % 100, r.rate_percentage, r.line_no) for r in got[1:]] == [
        (1, D("0.05"), 1), (1, D("0.10"), 2), (1, None, 3),
        (2, D("0.05"), 4), (2, D("0.10"), 5), (2, None, 6),
    ]
    assert all(58 not in cells(r) for r in got)


def test_china_steps_and_texts(records):
    got = of(records, 3)
    assert [(r.kind, r.line_no) for r in got] == [
        ("REC", 1), ("REV", 1), ("REV", 2), ("TAX", 1), ("TAX", 2), ("REV", 3), ("TAX", 3),
        ("REV", 4), ("TAX", 4),
    ]
    assert {cells(r)[54] for r in got} == {"REF1 - FW Service charge"}


def test_china_strict_layout(tables, made_of):
    strict = of(ordered(job.records_of(tables, made_of, replace(P, strict_layout=True))), 3)
    wide = [r["line"].split(",") for r in strict]
    assert [len(w) for w in wide] == [96, 88, 96, 104, 104, 88, 104, 96, 104]
    assert wide[1][87] == "200.00" and wide[2][87] == "50.00"
    assert (wide[3][87], wide[3][95], wide[4][95]) == ("", "8.00", "2.00")


def test_india_columns_and_rejects(records, tables, made_of):
    rev, *tax = [cells(r) for r in of(records, 4)[1:]]
    assert (rev[92], rev[93], rev[95]) == ("IGST", "DL", "HS1")
    assert [(c[58], c[92]) for c in tax] == [("14.000", "IGST")] + [("0.500", "IGST")] * 2
    assert all(93 not in c and 95 not in c for c in tax)
    assert [r.kind for r in of(records, 5)] == ["REC"]
    found = job.rejects_of(tables, made_of).collect()
    assert [(r.invoice_prefix_seq_id, r.reason) for r in found] == [(5, "tax rate without a rule")]


def test_faults_collect_all_codes(rows, tmp_path):
    """A charge without a rule, on an invoice without site and contract; a relation without a line; commas in a cell."""
    charges = [("IN", 1, rel("IN"), "0.07", "100", "7"), ("IN", 1, rel("IN"), "0.18", "10", "1")]
    charges += [("RU", 2, rel("RU"), "0.2", "10", "2"), ("US", 3, rel("US"), "0.1", "10", "1"), ("US", 4, rel("US", 2), "0.1", "10", "1")]
    t = world(rows, charges)
    c = F.col
    no_site = c("invoice_prefix_seq_id").isin(1, 2)
    t["je_line"] = (
        t["je_line"].filter(~((c("invoice_prefix_seq_id") == 3) & (c("je_type") == "REC")))
        .withColumn("brin_reference_id", F.when(no_site, "REF9").otherwise(c("brin_reference_id")))
    )
    late = t["je_line"].filter("invoice_prefix_seq_id = 4 and je_type = 'REC'").withColumns(
        {"invoice_prefix_seq_id": F.lit(3).cast("long"), "billing_rel_id": F.lit(rel("US")).cast("long"),
         "je_line_seq_id": F.lit(900).cast("long"), "created_on": c("created_on") + F.expr("INTERVAL 9 DAYS")})
    t["je_line"] = t["je_line"].unionByName(late)
    lenient = replace(P, fail_on_rejects=False)
    made = job.outbound(t, lenient)
    found = {(r.invoice_prefix_seq_id, r.rate_percentage): r.codes for r in made.faults.collect()}
    assert found == {
        (1, D("0.07")): [job.NO_RULE, job.NO_SITE], (1, D("0.18")): [job.NO_SITE],
        (2, D("0.2")): [job.NO_SITE, job.NO_CONTRACT], (3, None): [job.NO_LINE],
    }
    assert {(r.invoice_prefix_seq_id, r.reason) for r in made.rejects.collect()} == {(1, job.NO_RULE), (3, job.NO_LINE)}
    with pytest.raises(ValueError, match="no contract"):
        job.outbound(t, replace(lenient, stop_codes=(job.NO_CONTRACT,)))
    # Held back: details of relations without a contract, and records with a comma of their own.
    t["je_line"] = t["je_line"].withColumn("project", F.when(c("invoice_prefix_seq_id") == 4, "a,b").otherwise(c("project")))
    with pytest.raises(ValueError, match="commas in a cell"):
        job.outbound(t, replace(lenient, stop_codes=(job.SHIFTED,)))
    made = job.outbound(t, replace(lenient, divert_codes=(job.NO_CONTRACT, job.SHIFTED)))
    held = Counter((r.invoice_prefix_seq_id, r.code) for r in made.held.collect())
    whole = Counter(r.invoice_prefix_seq_id for r in job.outbound(t, lenient).records.collect())
    sent = Counter(r.invoice_prefix_seq_id for r in made.records.collect())
    assert held[2, job.NO_CONTRACT] == 2 and held[4, job.SHIFTED] > 0
    assert sent + Counter(k for k, _ in held.elements()) == whole
    day = date(2020, 5, 6)
    with pytest.raises(ValueError, match="control totals"):
        write_outbound(job.outbound(t, lenient).records, made.trailers, "AR", day, str(tmp_path / "all"))
    assert write_outbound(made.records, made.trailers, "AR", day, str(tmp_path / "sent")).count() == 3


def test_files_and_control_totals(tables, made_of, records, tmp_path):
    expected = {}
    for r in records:
        expected.setdefault(r.file_country, []).append(r["line"])
    trailers = job.trailers_of(tables, made_of, P)
    for r in trailers.collect():
        assert r.n_rows == len(expected[r.file_country])
        end = f"BILCCL,CCLARINVES,20200515,TRAILER,{r.n_rows},prod"
        assert r["line"] == end
        expected[r.file_country].append(end)
    frame = job.records_of(tables, made_of, P)
    assert frame.filter(comma_count(F.col("line")) != 95).count() == 0
    out = tmp_path / "out"
    made = write_outbound(frame, trailers, "AR", date(2020, 5, 6), str(out), part_lines=4).collect()
    parts = {(r.file, r.file_part): r for r in made}
    for country, text in expected.items():
        name = f"AR.{country}-06May20"
        own = [parts.pop((name, n)) for n in range(-(-len(text) // 4))]
        for n, r in enumerate(own):
            (file,) = (out / f"run_seq_id={RUN}" / f"file={name}" / f"file_part={n}").glob("part-*")
            assert file.read_text().splitlines() == text[4 * n : 4 * n + 4]
            assert (r.first_line, r.lines) == (4 * n + 1, len(text[4 * n : 4 * n + 4]))
            assert r.sha256 == hashlib.sha256(file.read_bytes()).hexdigest() and r.bytes == file.stat().st_size
    assert not parts
    kept = [json.loads(x) for f in sorted((tmp_path / "out.manifest").glob("part-*")) for x in f.read_text().splitlines()]
    assert [(r["file"], r["file_part"], r["sha256"]) for r in kept] == sorted((r.file, r.file_part, r.sha256) for r in made)


def test_wrong_control_totals_fail(tables, made_of, tmp_path):
    frame, trailers = job.records_of(tables, made_of, P), job.trailers_of(tables, made_of, P)
    day, us = date(2020, 5, 6), F.col("file_country") == "US"
    cases = {
        "n_rows": (frame.filter(~(us & (F.col("kind") == "TAX"))), trailers),
        "trailers": (frame, trailers.filter(~us)),
        "shifted": (frame.withColumn("line", F.when(us, F.concat("line", F.lit(","))).otherwise(F.col("line"))), trailers),
    }
    for n, (records, ends) in enumerate(cases.values()):
        with pytest.raises(ValueError, match="control totals of a file are wrong"):
            write_outbound(records, ends, "AR", day, str(tmp_path / f"w{n}"))
        assert not (tmp_path / f"w{n}.manifest").exists()
    strict = job.records_of(tables, made_of, replace(P, strict_layout=True))
    assert write_outbound(strict, trailers, "AR", day, str(tmp_path / "s"), allow_shifted=True).count() == 7
    none = write_outbound(frame.limit(0), trailers.limit(0), "AR", day, str(tmp_path / "none"))
    assert none.count() == 0


def test_lines_are_numbered_by_counts(spark):
    """A file with a third of all lines in one invoice, ids far apart: numbers as by sorting."""
    rng = random.Random(4)
    rows = []
    for _ in range(900):
        invoice = rng.choice([5, 5, rng.randint(1, 10**12)])
        rows.append((1, rng.choice("ab"), 0, invoice, rng.choice([-1, rng.randint(0, 200_000)]), rng.randint(0, 10**6), None, "x"))
    rows = list({r[:6]: r for r in rows}.values()) + [(1, f, 1, 0, 0, 0, None, "end") for f in "ab"]
    schema = "run_seq_id long, file string, part int, invoice_prefix_seq_id long, line_start long, seq int, amount decimal(20,6), value string"
    got = with_line_numbers(spark.createDataFrame(rows, schema))
    assert "RangePartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    for file in "ab":
        own = sorted((r for r in got.collect() if r.file == file), key=lambda r: r.file_line)
        assert [r.file_line for r in own] == list(range(1, len(own) + 1))
        assert [tuple(r)[:6] for r in own] == sorted(r[:6] for r in rows if r[1] == file)


def test_lines_are_made_once(tables, made_of, tmp_path, spark):
    """The text of the records is worked out in one job: later steps read the stored lines."""
    calls = []

    def keep(df, name):
        calls.append((name, df))
        return materialize(df, name)

    frame, trailers = job.records_of(tables, made_of, P), job.trailers_of(tables, made_of, P)
    write_outbound(frame, trailers, "AR", date(2020, 5, 6), str(tmp_path / "once"), keep=keep)
    (_, text), (_, found) = calls
    assert text.columns[-1] == "value" and "concat_ws" not in found._jdf.queryExecution().executedPlan().toString()


def test_one_run_is_its_part_of_all_runs(tables, records):
    both = dict(tables)
    for n in ("run", "outbound_summary"):
        both[n] = tables[n].unionByName(tables[n].withColumn("run_seq_id", F.lit(8).cast("long")))
    one = job.outbound(both, replace(P, run=RUN, same_run=True, fail_on_rejects=False))
    assert [tuple(r) for r in ordered(one.records)] == [tuple(r) for r in records]
    with pytest.raises(ValueError, match="rejects"):
        job.outbound(both, replace(P, run=RUN))


def test_senders_totals_sites_and_lost_relations(rows):
    charges = [("US", n, rel("US", n), "0.1", "10", "1") for n in (1, 2, 3, 4)]
    charges += [("US", 4, rel("US", 5), "0.1", "10", "1"), ("MX", 6, rel("MX"), "0.1", "10", "1")]
    t = world(rows, charges)
    c = F.col
    invoice = c("invoice_prefix_seq_id")
    sender = F.when(invoice == 1, "ESB").when(invoice == 2, "AHB").otherwise("CCX")
    late = (c("billing_rel_id") == rel("US", 5)) & (c("je_type") == "REC")
    t["je_line"] = (
        t["je_line"]
        .filter((invoice != 3) | (c("je_type") != "AR"))
        .withColumn("in_sending_gl", sender)
        .withColumn("brin_reference_id", F.when(invoice == 6, "REF9").otherwise(c("brin_reference_id")))
        .withColumn("created_on", F.when(late, c("created_on") + F.expr("INTERVAL 3 DAYS")).otherwise(c("created_on")))
    )
    t["invoice_line"] = t["invoice_line"].withColumn("in_sending_gl", sender)
    t["billing_rel"] = t["billing_rel"].withColumn("seller_role", F.lit(None).cast("string"))
    got = job.outbound(t, replace(P, fail_on_rejects=False))
    found = ordered(got.records)
    rec, rev, _ = [cells(r) for r in of(found, 1)]
    assert rec[54] == "Various - Enterprise Standard Billing"
    assert rev[54] == "Work- done" and rev[83] == "000000" and rev[79] == "0000"
    rec, rev, _ = [cells(r) for r in of(found, 2)]
    assert rec[43] == "If questions please contact mail"
    assert rev[66].endswith("|OOB|0.000|5.000|b|c|d|mail|f|g") and rev[66].count("|") == 17
    assert [r.kind for r in of(found, 3)] == ["REV", "TAX"]
    assert [r.billing_rel_id for r in got.rejects.collect()] == [rel("US", 5)]
    assert [r.kind for r in of(found, 4)] == ["REC", "REV", "TAX"]
    run_types = {r.file_country: r.run_type for r in got.trailers.collect()}
    assert run_types == {"US": "prod", "MX": "test"}
    assert 16 not in cells(of(found, 6)[0]) and 48 not in cells(of(found, 6)[0])
