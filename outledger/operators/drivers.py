"""What a run covers: its countries, invoices and relations, with contracts and sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from outledger.functions import rules
from outledger.operators.counterparty import Tables
from outledger.operators.digest import GL, RECEIVABLE, digest_of
from outledger.operators.joins import dealt_join
from outledger.operators.picks import unique_per_key

# Fixed values of the interface.
MANUAL_INVOICE = "M"
REPORT_COUNTRY = "RU"


def of_run(df: DataFrame, run: int | None) -> DataFrame:
    return df if run is None else df.filter(F.col("run_seq_id") == run)


def invoice_countries(t: Tables) -> DataFrame:
    """Invoices made by the system, with their own unit and its present country."""
    return (
        t["invoice_prefix"]
        .filter(F.col("invoice_type") != MANUAL_INVOICE)
        .join(
            t["pl"].select(
                "pl_seq_id", "legal_entity_seq_id", "gl_identifier", "ccl_ar_interface_required"
            ),
            "pl_seq_id",
        )
        .join(t["legal_entity"], "legal_entity_seq_id")
        .join(t["country"].select("country_id", "country_code"), "country_id")
        .select(
            "invoice_prefix_seq_id",
            rules.invoice_number(
                F.col("nickname"), F.col("invoice_type"), F.col("lst_invoice_nbr")
            ).alias("document_number"),
            "gl_identifier",
            "ccl_ar_interface_required",
            "country_id",
            F.col("country_code").alias("file_country"),
        )
    )


def countries_in_run(t: Tables, run: int | None = None) -> DataFrame:
    """Countries with described invoice lines of an interface unit, per run."""
    invoices = invoice_countries(t).filter(
        (F.col("gl_identifier") == GL) & F.col("ccl_ar_interface_required").isin("Y", "O")
    )
    billed = (
        of_run(t["invoice_line"], run)
        .filter(F.col("service_desc").isNotNull())
        .select("run_seq_id", "invoice_prefix_seq_id")
        .distinct()
    )
    return (
        billed.join(invoices, "invoice_prefix_seq_id")
        .select("run_seq_id", "country_id", "file_country")
        .distinct()
    )


def rec_relations(t: Tables, run: int | None = None) -> DataFrame:
    """Per run, invoice and relation: the highest reference of its receivable lines."""
    return (
        digest_of(t, run)
        .filter(F.col("je_type") == RECEIVABLE)
        .groupBy("run_seq_id", "invoice_prefix_seq_id", "billing_rel_id")
        .agg(F.max("brin_reference_id").alias("brin_reference_id"))
    )


def invoices_in_run(t: Tables, cp: DataFrame, run: int | None = None) -> DataFrame:
    """One row per run and invoice with representative texts; every output is a maximum.

    Lines and journal rows are reduced to one row per invoice before they meet. A maximum over
    their pairs is the maximum of each side, and no pairs are built.
    """
    key = ["run_seq_id", "invoice_prefix_seq_id"]
    texts = (
        of_run(t["invoice_line"], run)
        .filter(F.col("service_desc").isNotNull())
        .groupBy(*key)
        .agg(
            F.coalesce(F.max("service_name_translated"), F.max("service_desc")).alias("serv_desc"),
            F.max("in_sending_gl").alias("sending_gl"),
        )
    )
    relations = cp.select("billing_rel_id", "use_global_cust_site", "buyer_ccl_bill_to_site")
    references = (
        rec_relations(t, run)
        .join(relations, "billing_rel_id")
        .groupBy(*key)
        .agg(
            F.max("brin_reference_id").alias("brin_reference_id"),
            F.max("use_global_cust_site").alias("use_global_cust_site"),
            F.max("buyer_ccl_bill_to_site").alias("ccl_bill_to_site"),
        )
    )
    own = invoice_countries(t).select(
        "invoice_prefix_seq_id", "document_number", "country_id", "file_country"
    )
    runs = t["run"].select("run_seq_id")
    return (
        texts.join(references, key)
        .join(runs, "run_seq_id", "left_semi")
        .join(own, "invoice_prefix_seq_id")
    )


def relations_of_invoices(t: Tables, run: int | None = None) -> DataFrame:
    """Unshadowed receivable relations of each run and invoice."""
    return (
        digest_of(t, run)
        .filter((F.col("je_type") == RECEIVABLE) & (F.col("open_lines") > 0))
        .select("run_seq_id", "invoice_prefix_seq_id", "billing_rel_id")
        .distinct()
    )


def contract_number(invoices: DataFrame, contracts: DataFrame) -> DataFrame:
    """Add the contract of the invoice's reference; flag a Russian invoice without one.

    The rule behind the lookup is not public, so the pairs come from the caller's table.
    """
    known = unique_per_key(contracts, ["reference_id"], "contract_number", "contract number")
    missing = (F.col("file_country") == REPORT_COUNTRY) & F.col("contract_number").isNull()
    return (
        dealt_join(invoices, known, {"brin_reference_id": "reference_id"}, spread_by=["invoice_prefix_seq_id"])
        .drop("reference_id")
        .withColumn("contract_missing", F.coalesce(missing, F.lit(False)))
    )


def customer_site(invoices: DataFrame, sites: DataFrame) -> DataFrame:
    """Add the customer site by global flag, bill-to site and reference; flag a missing one.

    The rule behind the lookup is not public, so the sites come from the caller's table. A NULL in
    its three keys matches a NULL of the invoice.
    """
    keys = ["use_global_cust_site", "bill_to_site", "reference_id"]
    known = unique_per_key(sites, keys, "customer_site", "customer site").alias("k")
    inv = invoices.alias("i")
    on = (
        F.col("i.use_global_cust_site").eqNullSafe(F.col("k.use_global_cust_site"))
        & F.col("i.ccl_bill_to_site").eqNullSafe(F.col("k.bill_to_site"))
        & F.col("i.brin_reference_id").eqNullSafe(F.col("k.reference_id"))
    )
    return inv.join(known, on, "left").select(
        "i.*", "customer_site", F.col("customer_site").isNull().alias("site_missing")
    )


def missing_contracts(t: Tables, run: int | None = None) -> DataFrame:
    """Russian documents of the run's day whose reference has no contract with a number.

    A reference counts as covered where any of its contract rows has a number. All documents are
    reported.
    """
    invoices = invoice_countries(t).filter(F.col("file_country") == REPORT_COUNTRY)
    billed = of_run(t["invoice_line"], run).select("run_seq_id", "invoice_prefix_seq_id").distinct()
    key = ["run_seq_id", "invoice_prefix_seq_id"]
    references = (
        digest_of(t, run)
        .filter((F.col("je_type") == RECEIVABLE) & (F.col("day_lines") > 0))
        .select(*key, "brin_reference_id")
        .distinct()
    )
    contracts = t["contracts"].filter(F.col("contract_number").isNotNull())
    covered = countries_in_run(t, run).filter(F.col("file_country") == REPORT_COUNTRY)
    report = (
        references.join(billed, key, "left_semi")
        .join(covered, "run_seq_id", "left_semi")
        .join(invoices, "invoice_prefix_seq_id")
        .join(contracts, F.col("brin_reference_id") == F.col("reference_id"), "left_anti")
        .select("run_seq_id", "document_number", "brin_reference_id")
        .distinct()
    )
    return report
