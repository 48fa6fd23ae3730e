"""The whole outbound job: records, trailers and exception tables of one run or of all runs."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from outledger.functions import rules
from outledger.functions.text import month_text
from outledger.operators import branches, digest, drivers, journal, numbering, rollup
from outledger.operators.counterparty import Tables, counterparties
from outledger.plans import layout
from outledger.runtime import bucketed, materialize

KEY = ["run_seq_id", "invoice_prefix_seq_id"]
RELATION = KEY + ["billing_rel_id"]
#: What tables and frames with a row per line or relation are stored by.
PLACE = ["invoice_prefix_seq_id", "billing_rel_id"]


@dataclass(frozen=True)
class Params:
    """Settings of the job.

    The two contact sites belong to the deployment and have no default. `same_run` may be set where
    an invoice never spans runs: VAT lines, source lines and invoice lines are then read from the
    run's own partitions only, and an invoice of the run with lines in another run fails the job.
    `placed` says that invoice lines are stored bucketed by invoice and relation (`place_tables`).
    """

    pop_site: str
    other_site: str
    run: int | None = None
    summary_gl: str = "CCA"
    same_run: bool = False
    seller_tax_type: bool = False
    strict_layout: bool = False
    fail_on_rejects: bool = True
    # Further codes of faults that stop the job, and those whose records are held back.
    stop_codes: tuple[str, ...] = ()
    divert_codes: tuple[str, ...] = ()
    # Fixed values of the interface: keys of the two look-up texts.
    local_word_key: tuple[str, str, str] = ("OUTBOUND", "CCL_AR", "CHINESE_CHAR")
    run_type_key: tuple[str, str, str] = ("INTERFACES", "cclar.out", "runtype")
    keep: Callable[[DataFrame, str], DataFrame] = field(default=materialize)
    keep_by: Callable[[DataFrame, str, list[str]], DataFrame] = field(default=bucketed)
    placed: bool = False


@dataclass(frozen=True)
class Prepared:
    """What records, trailers and rejects are made of."""

    countries: DataFrame
    heads: DataFrame
    relations: DataFrame
    recs: DataFrame
    charges: DataFrame
    numbered: DataFrame


@dataclass(frozen=True)
class Outbound:
    records: DataFrame
    trailers: DataFrame
    rejects: DataFrame
    missing_contracts: DataFrame
    faults: DataFrame
    held: DataFrame


def lookup_value(look_up: DataFrame, kind: str, code: str, name: str) -> DataFrame:
    """One-row frame with the value of a look-up text; several values, or none, fail the job."""
    rows = look_up.filter(
        (F.col("type") == kind) & (F.col("look_code") == code) & (F.col("look_name") == name)
    )
    found = F.count(F.lit(1))
    wrong = F.raise_error(F.lit(f"look-up {kind}/{code}/{name} must have exactly one row"))
    return rows.agg(
        F.when(found != 1, wrong.cast("string")).otherwise(F.max("value")).alias("value")
    )


def add_lookup(df: DataFrame, look_up: DataFrame, key: tuple[str, str, str], name: str) -> DataFrame:
    """Attach a look-up text to every row; the aggregate behind it has one row by construction."""
    value = lookup_value(look_up, *key).withColumnRenamed("value", name)
    return df.crossJoin(F.broadcast(value))


def place_tables(t: Tables, partition_by: list[str] | None = None) -> Tables:
    """Journal and invoice lines stored as the job reads them; to be done once per load.

    Journal lines lie in folders by type (and by `partition_by`, such as the run), bucketed by invoice
    and relation, so that one type is read alone and its joins need no shuffle. The lines that
    receivables come from are looked up by their number and stored by it, with few columns.
    """
    folders = [*(partition_by or []), "je_type"]
    sources = journal.source_lines(t)
    own = {
        "je_line": bucketed(t["je_line"], "je_line", PLACE, folders),
        "je_source": bucketed(sources, "je_source", ["je_line_seq_id"]),
        "invoice_line": bucketed(t["invoice_line"], "invoice_line", ["invoice_prefix_seq_id", "brid_billing_rel_id"]),
    }
    return ChainMap(own, t)


def run_tables(t: Tables, p: Params) -> Tables:
    """With `same_run`, journal and invoice lines of the run alone; an invoice with lines elsewhere is an error."""
    if not p.same_run or p.run is None:
        return t
    own = {}
    for n in ("je_line", "invoice_line"):
        own[n] = drivers.of_run(t[n], p.run)
        invoices = own[n].select("invoice_prefix_seq_id").distinct()
        elsewhere = t[n].filter(F.col("run_seq_id") != p.run).select("run_seq_id", "invoice_prefix_seq_id")
        found = elsewhere.join(invoices, "invoice_prefix_seq_id", "left_semi").limit(1).collect()
        if found:
            raise ValueError(
                f"same_run: invoice {found[0]['invoice_prefix_seq_id']} of run {p.run} has {n} rows in run {found[0]['run_seq_id']}"
            )
    if "je_source" in t:
        own["je_source"] = journal.source_lines({"je_line": own["je_line"]})
    return ChainMap(own, t)


def invoice_heads(
    t: Tables, cp: DataFrame, countries: DataFrame, run: int | None
) -> DataFrame:
    """Invoices of the covered countries with contract and customer site."""
    invoices = drivers.invoices_in_run(t, cp, run).join(
        countries, ["run_seq_id", "country_id"], "left_semi"
    )
    contracted = drivers.contract_number(invoices, t["contracts"])
    return drivers.customer_site(contracted, t["customer_site"]).select(
        *KEY, "serv_desc", "sending_gl", "country_id", "file_country", "contract_number",
        "contract_missing", "customer_site", "site_missing",
    )


# What records need of a line; the rest of the journal view is pruned before any join.
LINE_FACTS = [
    *RELATION, "file_country", "country_id", "country_code", "je_type", "je_line_seq_id",
    "biller_run_date", "invoice_number", "invoice_amount", "original_curr", "invoice_billing_ref",
    "invoice_header", "header_context", "ccl_ar_ibs", "b_buc", "s_buc", "adn", "invoice_contact",
    "contract_number", "customer_site", "serv_desc", "sending_gl", "in_sending_gl",
    "balancing_segment", "reference_id", "bill_rel_key", "je_line_type_cat", "expense_category",
    "je_line_type_sub_sub_cat", "je_line_tax_type", "je_line_type_interco", "tp_percentage",
    "vat_percentage", "bex_je_description", "seller_cost_center", "orig_gl_account",
    "expense_account", "exception_account", "account_vat", "sabrix_tax_type",
    "sbx_commodity_code", "tp_required", "partner_segment", "company_code", "project",
    "cost_center", "product_line", "product_line_tp", "seller_vat_regime", "max_unit_price",
]


def line_heads(t: Tables, cp: DataFrame, heads: DataFrame, p: Params) -> DataFrame:
    """Representative lines with all their facts: one REC line per relation, one AR line per invoice.

    Both kinds are picked by number from the journal's digest; their columns are fetched for the picked
    lines only. They are then enriched together, so each table is joined once, to a few rows.
    """
    types = (digest.RECEIVABLE, digest.TOTAL)
    recs = journal.representative_picks(t, digest.RECEIVABLE, p.run).withColumn("ar_total", F.lit(None).cast("decimal(20,6)"))
    totals = journal.total_picks(t, cp, p.run)
    # What an invoice has is joined to the picks, which are numbers; lines are fetched where they lie, and stored there.
    picks = recs.withColumn("picked_type", F.lit(types[0])).unionByName(totals.withColumn("picked_type", F.lit(types[1])))
    carried = ("ar_total", *[c for c in heads.columns if c not in KEY])
    lines = p.keep_by(journal.picked_lines(t, picks.join(heads, KEY), *types, carried=carried), "picked", PLACE)
    facts = journal.enrich(
        lines, t, cp, p.pop_site, p.other_site, one_vat_line=True,
        seller_tax_type=p.seller_tax_type, carried=carried, near=p.run is not None,
    )
    # Stored, so that their true size is known: a small table is sent to the lines.
    exceptions = p.keep(branches.account_exceptions(t["look_up"], t["je_line_type"]), "exceptions")
    codes = p.keep(t["company_code"], "company-codes")
    return branches.with_company(branches.with_exception(facts, exceptions), codes).select(*LINE_FACTS, "ar_total")


def invoice_amounts(t: Tables, heads: DataFrame, p: Params) -> DataFrame:
    """Rate rollup; for one run only the lines of its invoices enter it."""
    lines = t["invoice_line"]
    if p.run is not None:
        wanted = heads.select("invoice_prefix_seq_id").distinct()
        lines = lines.join(wanted, "invoice_prefix_seq_id", "left_semi")
        return rollup.rate_rollup(lines)
    return rollup.rate_rollup(lines, placed=p.placed)


def build_charges(t: Tables, relations: DataFrame, amounts: DataFrame) -> DataFrame:
    """Charges: facts of a relation and its amounts per rate, with steps inside the relation.

    `rate_start` counts the line numbers of the relation's earlier rates; `relation_steps` is the
    relation's total. Both use the partitioning by invoice and relation the join already needs.
    """
    joined = amounts.join(relations, ["invoice_prefix_seq_id", "billing_rel_id"])
    priced = branches.with_account(joined, journal.tp_accounts(t["gl_account"]))
    steps = branches.with_line_steps(priced)
    whole = Window.partitionBy("invoice_prefix_seq_id", "billing_rel_id", "run_seq_id")
    earlier = whole.orderBy(F.col("rate_percentage").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return steps.withColumn(
        "rate_start", F.coalesce(F.sum("steps").over(earlier), F.lit(0))
    ).withColumn("relation_steps", F.sum("steps").over(whole))


def relation_offsets(charges: DataFrame) -> DataFrame:
    """Per relation: the line numbers of its invoice that come before it.

    Only one narrow row per relation takes part in the running sum over the invoice.
    """
    totals = charges.groupBy(*RELATION).agg(F.max("relation_steps").alias("relation_steps"))
    return numbering.offsets(totals, KEY, "billing_rel_id", "relation_steps")


def number_charges(charges: DataFrame, before: DataFrame) -> DataFrame:
    """Add `line_start`: the line numbers of the invoice that come before the charge.

    Charges and offsets lie by invoice and relation; the run is compared by two bounds, so that the
    join keeps that place.
    """
    renamed = before.select(*[F.col(k).alias(f"_{k}") for k in RELATION], "offset")
    on = (F.col("run_seq_id") >= F.col("_run_seq_id")) & (F.col("run_seq_id") <= F.col("_run_seq_id"))
    for k in PLACE:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return (
        charges.join(renamed, on)
        .withColumn("line_start", F.col("offset") + F.col("rate_start"))
        .drop("offset", "rate_start", "relation_steps", "steps", *[f"_{k}" for k in RELATION])
    )


def rec_records(lines: DataFrame) -> DataFrame:
    """One receivable record per invoice that has a receivable-total line; its total came with the pick."""
    partner = rules.trading_partner(
        rules.needs_partner(F.col("tp_required")), F.col("partner_segment"), F.col("company_code")
    )
    return lines.filter(F.col("je_type") == "AR").withColumn("trading_partner", partner)


RECORD_COLUMNS = [
    "run_seq_id", "file_country", "country_code", "invoice_prefix_seq_id", "billing_rel_id",
    "rate_percentage", "kind", "line_start", "seq", "line_no", "account", "quantity",
    "unit_price", "amount", "line",
]


def rec_output(recs: DataFrame, local_word: Column) -> DataFrame:
    money = "decimal(20,6)"
    return recs.withColumn("line", layout.rec_line(local_word)).select(
        "run_seq_id",
        "file_country",
        "country_code",
        "invoice_prefix_seq_id",
        F.lit(None).cast("long").alias("billing_rel_id"),
        F.lit(None).cast("decimal(12,6)").alias("rate_percentage"),
        F.lit("REC").alias("kind"),
        F.lit(-1).cast("long").alias("line_start"),
        F.lit(0).alias("seq"),
        F.lit(1).cast("long").alias("line_no"),
        F.col("expense_account").alias("account"),
        F.lit(None).cast("long").alias("quantity"),
        F.lit(None).cast(money).alias("unit_price"),
        F.coalesce("ar_total", F.lit(0).cast(money)).alias("amount"),
        "line",
    )


def detail_output(details: DataFrame, local_word: Column, strict_layout: bool) -> DataFrame:
    return (
        details.withColumn("line", layout.detail_line(local_word, strict_layout))
        .drop("account")
        .withColumnRenamed("row_account", "account")
        .select(*RECORD_COLUMNS)
    )


# Codes of faults. A fault of the first two leaves the relation or charge without records.
NO_LINE, NO_RULE = "no journal line", "tax rate without a rule"
NO_SITE, NO_CONTRACT, SHIFTED = "no customer site", "no contract", "commas in a cell"
REJECTED = (NO_LINE, NO_RULE)


def faults_of(t: Tables, made_of: Prepared, run: int | None = None) -> DataFrame:
    """Relations and charges with a fault, and all `codes` of each.

    One row per relation and rate (NULL where the relation has no charge): a row with two faults shows
    both. All rules are looked at in one pass over the relations wanted.
    """
    flags = made_of.heads.select(*KEY, "site_missing", "contract_missing")
    wanted = drivers.relations_of_invoices(t, run).join(flags, KEY)
    found = made_of.relations.select(*RELATION, F.lit(True).alias("has_line"))
    unknown = branches.with_unsupported(made_of.charges).select(*RELATION, "rate_percentage", "unsupported")
    every = wanted.join(found, RELATION, "left").join(unknown, RELATION, "left")
    rules_ = {
        NO_LINE: F.col("has_line").isNull(), NO_RULE: F.col("unsupported"), NO_SITE: F.col("site_missing"),
        NO_CONTRACT: F.col("contract_missing"),
    }
    codes = F.array_compact(F.array(*[F.when(rule, F.lit(code)) for code, rule in rules_.items()]))
    return every.select(*RELATION, "rate_percentage", codes.alias("codes")).filter(F.size("codes") > 0)


def rejects_of(t: Tables, made_of: Prepared, run: int | None = None) -> DataFrame:
    """Relations without a usable journal line, and India's rates without a rule: a row per fault."""
    each = faults_of(t, made_of, run).select(*RELATION, "rate_percentage", F.explode("codes").alias("reason"))
    return each.filter(F.col("reason").isin(*REJECTED))


def shifted_records(records: DataFrame) -> DataFrame:
    """Records with more or fewer commas than their 96 columns have: a cell holds a comma of its own."""
    return records.filter(layout.comma_count(F.col("line")) != layout.COLUMNS - 1)


def stop_on(faults: DataFrame, codes: tuple[str, ...]) -> None:
    """Fail where a fault has one of the codes."""
    wanted = F.arrays_overlap("codes", F.array(*[F.lit(c) for c in codes]))
    first = faults.filter(wanted).limit(1).collect() if codes else []
    if first:
        raise ValueError(f"outbound run has rejects, such as {first[0].asDict()}")


def diverted(records: DataFrame, faults: DataFrame, codes: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The records to send, and those held back: of relations with a fault of `codes`, and shifted ones if asked."""
    if not codes:
        return records, records.limit(0).withColumn("code", F.lit(None).cast("string"))
    held = faults.select(*RELATION, F.explode("codes").alias("code")).filter(F.col("code").isin(*codes))
    held = held.groupBy(*RELATION).agg(F.min("code").alias("code"))
    marked = records.join(held, RELATION, "left")
    if SHIFTED in codes:
        shifted = layout.comma_count(F.col("line")) != layout.COLUMNS - 1
        marked = marked.withColumn("code", F.coalesce("code", F.when(shifted, F.lit(SHIFTED))))
    return marked.filter("code is null").drop("code").select(*records.columns), marked.filter("code is not null")


def trailers_of(t: Tables, made_of: Prepared, p: Params) -> DataFrame:
    """One control row per run and country: the rows written and the run type.

    Row counts come from the charges, so the records are not made twice.
    """
    key = ["run_seq_id", "country_id"]
    made = made_of.recs.select(*key, F.lit(1).cast("long").alias("made")).unionByName(
        branches.with_row_count(made_of.charges).select(*key, "made")
    )
    counts = made.groupBy(*key).agg(F.sum("made").alias("made"))
    errors = made_of.heads.groupBy(*key).agg(F.bool_or("site_missing").alias("site_error"))
    # A run has one summary row; two of them, like none, fail the trailers.
    one = F.when(F.count("*") > 1, F.raise_error(F.lit("more than one summary row of a run")).cast("timestamp"))
    month = (
        t["outbound_summary"]
        .filter(F.col("gl_identifier") == p.summary_gl)
        .groupBy("run_seq_id").agg(one.otherwise(F.max("run_on")).alias("run_on"))
        .select("run_seq_id", month_text(F.col("run_on")).alias("run_month"))
    )
    no_month = F.raise_error(F.lit("a run has no summary row")).cast("string")
    files = (
        made_of.countries.join(counts, key, "left")
        .join(errors, key, "left")
        .join(month, "run_seq_id", "left")
    )
    checked = F.coalesce(F.col("run_month"), no_month)
    run_type = F.when(F.col("site_error"), F.lit("test")).otherwise(F.col("set_run_type"))
    n = F.coalesce("made", F.lit(0).cast("long"))
    return add_lookup(files, t["look_up"], p.run_type_key, "set_run_type").select(
        "run_seq_id",
        "file_country",
        checked.alias("run_month"),
        n.alias("n_rows"),
        run_type.alias("run_type"),
        layout.trailer_line(checked, n, run_type).alias("line"),
    )


def recounted(trailers: DataFrame, held: DataFrame) -> DataFrame:
    """Trailers whose row counts leave out the records held back."""
    key = ["run_seq_id", "file_country"]
    lost = held.groupBy(*key).agg(F.count("*").alias("lost"))
    n = F.col("n_rows") - F.coalesce("lost", F.lit(0))
    return trailers.join(lost, key, "left").select(
        *key, "run_month", n.alias("n_rows"), "run_type",
        layout.trailer_line(F.col("run_month"), n, F.col("run_type")).alias("line"),
    )


def prepare(t: Tables, p: Params) -> Prepared:
    """Countries, invoice heads, relations, receivable rows and numbered charges.

    The frames that several results read are written once to the checkpoint folder. The journal is read
    in one narrow pass for its digest, which answers references, picks, totals and reports; after that
    only picked lines, VAT lines and sources are read. Frames with a row per relation are stored by
    invoice and relation, so that they meet without a shuffle.
    """
    t = with_digest(t, p)
    cp = p.keep(counterparties(t), "counterparties")
    countries = p.keep(drivers.countries_in_run(t, p.run), "countries")
    heads = p.keep(invoice_heads(t, cp, countries, p.run), "invoices")
    lines = p.keep_by(line_heads(t, cp, heads, p), "lines", PLACE)
    relations = lines.filter(F.col("je_type") == "REC").drop("ar_total")
    charges = p.keep_by(build_charges(t, relations, invoice_amounts(t, heads, p)), "charges", PLACE)
    offsets = p.keep_by(relation_offsets(charges), "offsets", PLACE)
    return Prepared(countries, heads, relations, rec_records(lines), charges, number_charges(charges, offsets))


def with_digest(t: Tables, p: Params) -> Tables:
    """The tables and the journal's digest, stored."""
    if "journal_digest" in t:
        return t
    return ChainMap({"journal_digest": p.keep_by(digest.journal_digest(t, p.run), "journal_digest", PLACE)}, t)


def records_of(t: Tables, made_of: Prepared, p: Params) -> DataFrame:
    """All records in the common output shape."""
    word = F.col("local_word")
    recs = add_lookup(made_of.recs, t["look_up"], p.local_word_key, "local_word")
    charges = add_lookup(made_of.numbered, t["look_up"], p.local_word_key, "local_word")
    detail = detail_output(branches.revtax(charges), word, p.strict_layout)
    return rec_output(recs, word).unionByName(detail)


def outbound(t: Tables, p: Params) -> Outbound:
    """Records, trailers, rejects and the missing-contract report of a run, or of all runs."""
    tables = with_digest(run_tables(t, p), p)
    made_of = prepare(tables, p)
    faults = p.keep(faults_of(tables, made_of, p.run), "faults")
    codes = (*(REJECTED if p.fail_on_rejects else ()), *p.stop_codes)
    stop_on(faults, codes)
    records = records_of(tables, made_of, p)
    if SHIFTED in p.stop_codes:
        lost = shifted_records(records).select(*RELATION, "line").limit(1).collect()
        if lost:
            raise ValueError(f"outbound run has a record with {SHIFTED}: {lost[0].asDict()}")
    trailers = trailers_of(tables, made_of, p)
    sent, held = diverted(records, faults, p.divert_codes)
    if p.divert_codes:
        trailers = recounted(trailers, held)
    return Outbound(
        records=sent,
        trailers=trailers,
        rejects=rejects_of(tables, made_of, p.run),
        missing_contracts=drivers.missing_contracts(tables, p.run),
        faults=faults,
        held=held,
    )
