"""Amounts of an invoice by relation and tax rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from outledger.operators import numbering

MONEY = "decimal(20,6)"


def rate_rollup(lines: DataFrame, placed: bool = False) -> DataFrame:
    """Item amount, VAT amount and description per invoice, relation and rate.

    HEADER lines are left out; other line types keep their rate but add nothing. The description
    prefers a translated name within each line type.

    Lines with the same texts are summed first, by a hash aggregate that combines on the map side: the
    texts are grouping keys there. Only the few different texts of a relation are then compared. That
    happens where invoice and relation are together, which the later join with the relation's journal
    line can use as it is. `placed` says that `lines` are stored bucketed by invoice and relation; then
    nothing is moved at all.
    """
    amount = F.col("tax_comp_amt") + F.col("ntax_comp_amt")
    keys = ["invoice_prefix_seq_id", "brid_billing_rel_id"]

    def total(line_type: str):
        zero = F.lit(0).cast(MONEY)
        return F.sum(F.when(F.col("inv_line_type") == line_type, F.col("amount")).otherwise(zero)).cast(MONEY)

    by_text = (
        lines.filter(F.col("inv_line_type") != "HEADER")
        .filter(F.col("inv_line_type") != "")
        .groupBy(*keys, "rate_percentage", "inv_line_type", "service_name_translated", "service_desc")
        .agg(F.sum(amount).alias("amount"))
    )
    near = by_text if placed else by_text.repartition(*keys)
    by_type = near.groupBy(*keys, "rate_percentage", "inv_line_type").agg(
        F.sum("amount").alias("amount"),
        F.coalesce(F.max("service_name_translated"), F.max("service_desc")).alias("service_desc"),
    )
    return (
        by_type.groupBy(*keys, "rate_percentage")
        .agg(
            total("ITEM").alias("item"),
            total("VAT").alias("vat"),
            F.max("service_desc").alias("service_desc"),
        )
        .withColumnRenamed("brid_billing_rel_id", "billing_rel_id")
    )


def ar_totals(je_lines: DataFrame) -> DataFrame:
    """Receivable total of each run and invoice, shadow lines included."""
    return (
        je_lines.filter((F.col("je_type") == "AR") & (F.col("brin_op_gl") == "CCL"))
        .groupBy("run_seq_id", "invoice_prefix_seq_id")
        .agg(F.sum("billing_amt").cast(MONEY).alias("ar_total"))
    )


def ar_totals_of(digest: DataFrame) -> DataFrame:
    """The same totals from the journal's digest."""
    return (
        digest.filter(F.col("je_type") == "AR")
        .groupBy("run_seq_id", "invoice_prefix_seq_id")
        .agg(F.sum("total").cast(MONEY).alias("ar_total"))
    )


def account_list(accounts: DataFrame) -> DataFrame:
    """The distinct account numbers as rows, whatever their number; membership tests join them."""
    return accounts.select("acct_number").distinct()


def account_texts(accounts: DataFrame, part_rows: int = 1000, separator: str = ",") -> DataFrame:
    """The distinct account numbers as one ordered list, in numbered parts of `part_rows` each.

    part and accounts (a text); the parts by number, put together, are the whole list, however long it
    is. Places in the list are sums of counts over ranges of the first characters, so no task sorts
    all numbers; only the accounts of one part are gathered.
    """
    known = account_list(accounts.dropna(subset=["acct_number"]))
    # The first 7 bytes as a number: it grows with the text.
    start = F.rpad(F.hex(F.substring(F.encode("acct_number", "UTF-8"), 1, 7)), 14, "0")
    keyed = known.withColumns({"list": F.lit(0), "start": F.conv(start, 16, 10).cast("long")})
    counts = keyed.groupBy("list", "start").agg(F.count("*").alias("n"))
    before = numbering.offsets(counts, ["list"], "start", "n")
    inside = F.row_number().over(Window.partitionBy("list", "start").orderBy("acct_number"))
    placed = keyed.join(before, ["list", "start"]).withColumn("place", F.col("offset") + inside - 1)
    part = F.floor(F.col("place") / part_rows)
    return placed.groupBy(part.alias("part")).agg(
        F.array_join(F.array_sort(F.collect_list("acct_number")), separator).alias("accounts")
    )
