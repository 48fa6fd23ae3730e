"""One narrow pass over the journal: what later steps ask of its lines, per relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from outledger.operators.counterparty import Tables

# Fixed values of the interface.
GL = "CCL"
RECEIVABLE, TOTAL = "REC", "AR"


def unshadowed():
    return F.coalesce("shadow_ind", F.lit("N")) == "N"


def in_run_window(created, run_date):
    """Made at most a day before or after the run."""
    return created.between(run_date - F.expr("INTERVAL 1 DAY"), run_date + F.expr("INTERVAL 1 DAY"))


def on_run_day(created, run_date):
    day = F.date_trunc("DAY", run_date)
    return created.between(day, day + F.expr("INTERVAL 86399 SECONDS"))


def journal_digest(t: Tables, run: int | None = None) -> DataFrame:
    """Receivable and total lines of the interface's ledger, summed up.

    One row per run, invoice, relation, line type and reference: `first_line` (lowest id of an
    unshadowed line made around its run; NULL without one), `open_lines` (unshadowed ones), `day_lines`
    (made on the run's day; NULL where the run is unknown), `total` and the run's date. Every value is a number, so a
    hash aggregate combines lines on the map side, however many a relation has; texts are fetched
    later, for the lines that are picked.
    """
    lines = t["je_line"].filter(F.col("je_type").isin(RECEIVABLE, TOTAL) & (F.col("brin_op_gl") == GL))
    runs = t["run"]
    if run is not None:
        lines, runs = lines.filter(F.col("run_seq_id") == run), runs.filter(F.col("run_seq_id") == run)
    dates = runs.groupBy(F.col("run_seq_id").alias("r_run_seq_id")).agg(F.max("run_date").alias("run_date"))
    dated = lines.join(dates, F.col("run_seq_id") == F.col("r_run_seq_id"), "left")
    created, run_date = F.col("created_on"), F.col("run_date")
    usable = unshadowed() & in_run_window(created, run_date)
    count = lambda condition: F.sum(condition.cast("long"))
    return dated.groupBy(
        "run_seq_id", "invoice_prefix_seq_id", "billing_rel_id", "je_type", "brin_reference_id"
    ).agg(
        F.min(F.when(usable, F.col("je_line_seq_id"))).alias("first_line"),
        count(unshadowed()).alias("open_lines"),
        count(on_run_day(created, run_date)).alias("day_lines"),
        F.sum("billing_amt").alias("total"),
        F.max("run_date").alias("run_date"),
    )


def digest_of(t: Tables, run: int | None = None) -> DataFrame:
    """The stored digest where the job has made one, or else a pass over the journal."""
    if "journal_digest" in t:
        found = t["journal_digest"]
        return found if run is None else found.filter(F.col("run_seq_id") == run)
    return journal_digest(t, run)
