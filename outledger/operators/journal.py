"""Outbound journal: journal lines with run, invoice, relation and account facts."""

from __future__ import annotations

from collections import ChainMap

from pyspark.sql import Column, DataFrame, functions as F

from outledger.functions import rules
from outledger.operators.counterparty import Tables, as_role
from outledger.operators.digest import RECEIVABLE, TOTAL, digest_of, in_run_window, unshadowed
from outledger.operators.joins import HOT_ROWS, dealt_join, hot_keys, present
from outledger.operators.pairs import PairView, member_groups
from outledger.runtime import shuffle_partitions

# Fixed values of the interface.
OUTBOUND_TYPES = ["REC", "TP", "AR"]
SOURCE_TYPES = ["INC", "INCB", "CRN", "CRNB"]


def tp_flag(gl_accounts: DataFrame) -> DataFrame:
    """Per account number: the highest trading-partner flag among its active rows."""
    return (
        gl_accounts.filter(F.col("is_active") == "Y")
        .groupBy("acct_number")
        .agg(F.max("tp_required").alias("tp_required"))
    )


def tp_accounts(gl_accounts: DataFrame) -> DataFrame:
    """Active accounts that ask for a trading partner, as a set of keys."""
    return (
        gl_accounts.filter((F.col("is_active") == "Y") & F.col("tp_required").isin("Y", "T"))
        .select("acct_number")
        .distinct()
    )


def product_line(cost_centers: DataFrame) -> DataFrame:
    """First product line per cost center, NULL last: the minimum, which ignores NULL."""
    return cost_centers.groupBy("cost_center").agg(F.min("product_line").alias("product_line"))


def outbound_lines(t: Tables, run: int | None = None) -> DataFrame:
    """Lines of the outbound types, unshadowed, with a 3-letter ledger, made around their run."""
    lines = t["je_line"].filter(
        F.col("je_type").isin(OUTBOUND_TYPES) & (F.length("brin_op_gl") == 3) & unshadowed()
    )
    runs = t["run"]
    if run is not None:
        lines, runs = lines.filter(F.col("run_seq_id") == run), runs.filter(F.col("run_seq_id") == run)
    runs = runs.select(F.col("run_seq_id").alias("r_run_seq_id"), F.col("run_date").alias("biller_run_date"))
    on = (F.col("run_seq_id") == F.col("r_run_seq_id")) & in_run_window(
        F.col("created_on"), F.col("biller_run_date")
    )
    return lines.join(runs, on).drop("r_run_seq_id")


def invoice_facts(t: Tables, first_header: bool = False) -> DataFrame:
    """Invoices with prefix, header and the total of their HEADER line.

    With `first_header` an invoice has one row: the lowest total, and the number of `headers`.
    """
    header = t["invoice_line"].filter(F.col("inv_line_type") == "HEADER").select(
        "invoice_prefix_seq_id",
        (F.col("tax_comp_amt") + F.col("ntax_comp_amt")).cast("decimal(20,6)").alias("invoice_amount"),
    )
    if first_header:
        header = header.groupBy("invoice_prefix_seq_id").agg(
            F.min("invoice_amount").alias("invoice_amount"), F.count("*").alias("headers")
        )
    prefix = t["invoice_prefix"].select(
        "invoice_prefix_seq_id",
        "nickname",
        "invoice_type",
        rules.invoice_number(F.col("nickname"), F.col("invoice_type"), F.col("lst_invoice_nbr")).alias(
            "invoice_number"
        ),
    )
    inh = t["invoice_header"].select(
        "invoice_prefix_seq_id",
        F.col("billing_ref").alias("invoice_billing_ref"),
        rules.header_text(
            F.col("settlement_type"), F.col("from_buc"), F.col("to_buc"), F.col("bic"), F.col("iban")
        ).alias("invoice_header"),
    )
    return prefix.join(inh, "invoice_prefix_seq_id").join(header, "invoice_prefix_seq_id")


RELATION_KEYS = ["invoice_prefix_seq_id", "billing_rel_id"]


def vat_lines(t: Tables, one_per_relation: bool = False) -> DataFrame:
    """VAT journal lines by invoice and relation; all of them, or the one with the lowest id and their number."""
    vat = t["je_line"].filter(F.col("je_type") == "VAT").select(
        *RELATION_KEYS,
        F.col("je_line_seq_id").alias("vat_line_seq_id"),
        F.col("gl_account").alias("account_vat"),
        F.col("je_line__type_sub_cat").alias("sabrix_tax_type"),
    )
    if not one_per_relation:
        return vat
    known = vat.dropna(subset=RELATION_KEYS)
    groups = member_groups(known, RELATION_KEYS, "vat_line_seq_id", ("account_vat", "sabrix_tax_type"))
    return groups.withColumnRenamed("members", "vat_lines")


def vat_pairs(t: Tables, lines: DataFrame) -> PairView:
    """Lines and the VAT lines of their invoice and relation, as factors."""
    vat = t["je_line"].filter(F.col("je_type") == "VAT").select(
        *RELATION_KEYS, F.col("je_line_seq_id").alias("vat_line_seq_id"), F.col("gl_account").alias("account_vat"),
        F.col("je_line__type_sub_cat").alias("sabrix_tax_type"), F.col("billing_amt").alias("vat_amt"),
    )
    return PairView(lines, vat.dropna(subset=RELATION_KEYS), RELATION_KEYS, "vat_line_seq_id")


def source_lines(t: Tables) -> DataFrame:
    """Lines that receivables come from; a stored copy by line id where the caller has one."""
    if "je_source" in t:
        return t["je_source"]
    return t["je_line"].filter(F.col("je_type").isin(SOURCE_TYPES)).select(
        "je_line_seq_id", "in_je_description", "gl_account", "brin_cost_center", "brin_balancing_segment"
    )


def seller_tax_types(t: Tables) -> DataFrame:
    """Older rule for the tax type: the seller's own VAT registration of the relation."""
    return t["vat_gst"].filter(F.col("vat_gst_type") == "SELLER").select(
        "billing_rel_id", "sabrix_tax_type"
    )


def active_services(services: DataFrame) -> DataFrame:
    return services.filter((F.col("is_active_ind") == "Y") & F.col("code").isNotNull()).select(
        "code", "sbx_commodity_code"
    )


#: Sources of a relation from which lines are dealt by their source, too, to meet its facts.
CROWDED = 4096


def line_origins(lines: DataFrame, origin: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The origin of every source that REC lines name, at the place of the lines' relation.

    Only numbers go to the origins, never the lines. The result lies by `_invoice_prefix_seq_id` and
    `_billing_rel_id`, as the lines may do by theirs.
    """
    wanted = lines.filter(F.col("je_type") == RECEIVABLE).select(*RELATION_KEYS, "src_je_line_seq_id").dropna().distinct()
    hot = None if hot_rows is None else present(hot_keys(wanted, ["src_je_line_seq_id"], hot_rows))
    met = dealt_join(wanted, origin, {"src_je_line_seq_id": "origin_je_line_seq_id"}, hot, RELATION_KEYS)
    found = met.filter(F.col("origin_je_line_seq_id").isNotNull()).drop("src_je_line_seq_id")
    renamed = found.withColumnsRenamed({k: f"_{k}" for k in RELATION_KEYS})
    return renamed.repartition(shuffle_partitions(lines.sparkSession), *[f"_{k}" for k in RELATION_KEYS])


def with_origin(lines: DataFrame, origins: DataFrame) -> DataFrame:
    """Lines with the origin of `line_origins`, REC lines alone; lines stored by invoice and relation stay where they are.

    There a line is compared with the origins of all lines of its relation. Where a relation has `CROWDED`
    sources or more, lines and origins are dealt by the source's number, too.
    """
    source, number = F.col("src_je_line_seq_id"), F.col("origin_je_line_seq_id")
    counted = lines.filter((F.col("je_type") == RECEIVABLE) & source.isNotNull()).groupBy(*RELATION_KEYS).count()
    crowded = present(counted.filter(F.col("count") >= CROWDED))
    on = (F.col("je_type") == RECEIVABLE) & ((source >= number) & (source <= number) if crowded is None else source == number)
    for k in RELATION_KEYS:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return lines.join(origins, on, "left").drop("origin_je_line_seq_id", *[f"_{k}" for k in RELATION_KEYS])


def enrich(
    lines: DataFrame,
    t: Tables,
    cp: DataFrame,
    pop_site: str,
    other_site: str,
    one_vat_line: bool = False,
    seller_tax_type: bool = False,
    carried: tuple[str, ...] = (),
    near: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add relation, invoice, source line, VAT line, account and cost-center facts.

    `one_vat_line` keeps one row per journal line: the first VAT line of its invoice and relation
    and the first HEADER line, and `view_rows`, the rows of the plain join that it stands for. Without
    it a line is repeated for all of them, as in that join.
    Origins and facts of invoice and relation come to the lines: numbers go to the tables, and what is found there
    comes to the lines' invoice and relation. Lines stored by these don't move for it. Lines without a key of a looked-up table
    pass it by, and keys with `hot_rows` lines or more are dealt in parts (None: not counted, for lines that are
    few); `lines` is read for that, so it should be stored.
    `carried` names further columns of `lines` to keep. `near` is for a few lines out of a long
    history: the other lines are first cut to those the given ones can meet, so that a left join
    does not shuffle the history.
    """
    c = F.col
    origin = as_role(source_lines(t), "origin")
    facts = t
    if near:
        invoices = lines.select("invoice_prefix_seq_id").distinct()
        facts = ChainMap(
            {
                n: t[n].join(invoices, "invoice_prefix_seq_id", "left_semi")
                for n in ("je_line", "invoice_line", "invoice_prefix", "invoice_header")
            },
            t,
        )
        origins = lines.select(c("src_je_line_seq_id").alias("origin_je_line_seq_id")).distinct()
        origin = origin.join(origins, "origin_je_line_seq_id", "left_semi")
    vat = vat_lines(facts, one_per_relation=one_vat_line)
    if seller_tax_type:
        vat = vat.drop("sabrix_tax_type")
        cp = cp.join(seller_tax_types(t), "billing_rel_id", "left")

    def looked_up(left: DataFrame, right: DataFrame, name: str, other: str) -> DataFrame:
        # Without a hot key it is a plain join: a table that is small is sent to the lines.
        hot = None if hot_rows is None else present(hot_keys(lines, [name], hot_rows))
        return dealt_join(left, right, {name: other}, hot, ["je_line_seq_id"])

    relations = lines.select(*RELATION_KEYS).distinct()
    of_invoice = relations.join(invoice_facts(facts, first_header=one_vat_line), "invoice_prefix_seq_id")
    of_relation = relations.join(cp, "billing_rel_id")
    full = (
        with_origin(lines, line_origins(lines, origin, hot_rows))
        .join(vat, RELATION_KEYS, "left")
        .join(of_relation, RELATION_KEYS)
        .join(of_invoice, RELATION_KEYS)
    )
    full = looked_up(full, tp_flag(t["gl_account"]), "gl_account", "acct_number")
    full = looked_up(full, product_line(t["cost_center"]), "brin_cost_center", "cost_center")
    full = looked_up(full, active_services(t["service"]), "service_code", "code")
    rows_of_view = [
        (F.greatest(F.coalesce("vat_lines", F.lit(0)), F.lit(1)) * F.col("headers")).alias("view_rows")
    ] if one_vat_line else []
    entity = [c("je_line_type_cat"), c("je_line__type_sub_cat"), c("je_line_type_id")]
    segments = [c("b_bal_seg"), c("s_bal_seg"), c("origin_brin_balancing_segment")]
    zero = F.lit(0).cast("decimal(12,6)")
    return full.select(
        "run_seq_id",
        "invoice_prefix_seq_id",
        "in_sending_gl",
        "je_line_seq_id",
        c("brin_op_gl").alias("op_gl_system"),
        c("brin_balancing_segment").alias("balancing_segment"),
        rules.masked_reference(c("in_sending_gl"), c("brin_reference_id")).alias("reference_id"),
        "invoice_billing_ref",
        c("brin_cost_center").alias("cost_center"),
        "project",
        "outbound_id",
        c("billing_curr").alias("original_curr"),
        c("billing_amt").alias("original_amt"),
        "invoice_amount",
        c("run_rec_number").alias("acc_record_number"),
        "billing_rel_id",
        c("gl_account").alias("expense_account"),
        c("je_line__type_sub_cat").alias("expense_category"),
        "biller_run_date",
        F.coalesce("vat_percentage", zero).alias("vat_percentage"),
        F.coalesce("tp_percentage", zero).alias("tp_percentage"),
        "je_line_type_cat",
        "je_line_type_sub_sub_cat",
        "je_line_tax_type",
        "je_line_type_interco",
        "src_je_line_seq_id",
        "tp_type",
        c("invoice_prefix_seq_id").alias("je_invoice_prefix"),
        c("nickname").alias("invoice_prefix_nickname"),
        "invoice_type",
        "invoice_number",
        "is_taxable",
        rules.contact_text(
            c("in_sending_gl"), c("in_je_description"), c("route_type"), pop_site, other_site
        ).alias("invoice_contact"),
        rules.relation_key(
            c("route_type"), c("route_id"), c("route_version"), c("bill_rel_key")
        ).alias("bill_rel_key"),
        "je_type",
        c("origin_in_je_description").alias("bex_je_description"),
        c("origin_gl_account").alias("orig_gl_account"),
        c("origin_brin_cost_center").alias("seller_cost_center"),
        rules.intercompany_entity(*entity, c("b_me"), c("s_me"), *segments).alias("ime"),
        rules.intercompany_legal_entity(
            *entity, c("s_le"), c("b_le"), c("b_buc_mars_le"), *segments
        ).alias("ile"),
        "account_vat",
        "consumption_per",
        "s_buc",
        "b_buc",
        c("buyer_ccl_bill_to_site").alias("ccl_bill_to_site"),
        "s_gl",
        "b_gl",
        "s_bal_seg",
        "b_bal_seg",
        "invoice_header",
        "plcontact",
        F.coalesce("max_unit_price", F.lit(0).cast("decimal(20,6)")).alias("max_unit_price"),
        "country_code",
        "country_code_iso3166",
        "header_context",
        "product_line",
        # The product line of trading-partner lines comes from the same prepared table.
        F.when(c("je_type") == "TP", c("product_line")).alias("product_line_tp"),
        "buc",
        "adn",
        "ccl_ar_ibs",
        "use_global_cust_site",
        "tp_required",
        "ccl_ar_interface_required",
        "settlement_type",
        "service_code",
        "sbx_commodity_code",
        "sabrix_tax_type",
        "seller_vat_regime",
        "vat_line_seq_id",
        *rows_of_view,
        *carried,
    )


def outbound_journal(
    t: Tables,
    cp: DataFrame,
    pop_site: str,
    other_site: str,
    run: int | None = None,
    seller_tax_type: bool = False,
    expanded: bool = False,
) -> DataFrame:
    """The outbound view, one row per line: with its first VAT and HEADER line and `view_rows`, the rows it stands for.

    `expanded` gives the plain view instead: every line, repeated for every VAT and HEADER line.
    """
    return enrich(
        outbound_lines(t, run), t, cp, pop_site, other_site, one_vat_line=not expanded,
        seller_tax_type=seller_tax_type, near=run is not None, hot_rows=None,
    )


# Columns a representative line carries; the others are never read.
LINE_COLUMNS = [
    "run_seq_id", "invoice_prefix_seq_id", "billing_rel_id", "je_line_seq_id",
    "src_je_line_seq_id", "je_type", "in_sending_gl", "brin_op_gl", "brin_balancing_segment",
    "brin_reference_id", "brin_cost_center", "project", "outbound_id", "billing_curr",
    "billing_amt", "run_rec_number", "gl_account", "je_line_type_id", "je_line_type_cat",
    "je_line__type_sub_cat", "je_line_type_sub_sub_cat", "je_line_tax_type",
    "je_line_type_interco", "vat_percentage", "tp_percentage", "tp_type", "is_taxable",
    "in_je_description", "service_code",
]


def representative_picks(t: Tables, je_type: str, run: int | None = None, relations: DataFrame | None = None) -> DataFrame:
    """Run, invoice, relation, id of the lowest open line and date of the run: per relation, or per invoice for totals.

    With `relations`, only lines of these billing relations can be picked. Made of the journal's digest,
    so only numbers are compared.
    """
    found = digest_of(t, run).filter((F.col("je_type") == je_type) & F.col("first_line").isNotNull())
    per_relation = found.groupBy("run_seq_id", *RELATION_KEYS).agg(
        F.min("first_line").alias("first_line"), F.max("run_date").alias("biller_run_date")
    )
    if relations is not None:
        per_relation = per_relation.join(relations.select("billing_rel_id"), "billing_rel_id", "left_semi")
    if je_type == TOTAL:
        lowest = F.min(F.struct("first_line", "billing_rel_id", "biller_run_date")).alias("lowest")
        per_relation = per_relation.groupBy("run_seq_id", "invoice_prefix_seq_id").agg(lowest).select(
            "run_seq_id", "invoice_prefix_seq_id", "lowest.*"
        )
    return per_relation.select("run_seq_id", *RELATION_KEYS, "first_line", "biller_run_date")


def picked_lines(t: Tables, picks: DataFrame, *je_types: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """The picked lines with their columns, fetched from the journal after the pick, and `carried` ones of the picks.

    Picks for several types name theirs in `picked_type`.

    The join is by invoice and relation, as the journal may be stored by these; a line's number is
    compared by two bounds, which leaves that partitioning as it is.
    """
    lines = t["je_line"].filter(F.col("je_type").isin(*je_types)).select(*LINE_COLUMNS)
    own_type = ["picked_type"] if len(je_types) > 1 else []
    chosen = picks.select(
        *[F.col(k).alias(f"_{k}") for k in RELATION_KEYS], F.col("run_seq_id").alias("_run"), "first_line",
        "biller_run_date", *own_type, *carried,
    )
    on = F.lit(True)
    for k in RELATION_KEYS:
        on = on & (F.col(k) == F.col(f"_{k}"))
    number = F.col("je_line_seq_id")
    on = on & (number >= F.col("first_line")) & (number <= F.col("first_line"))
    # Ids are unique in a run; the run is compared in case they aren't across runs.
    on = on & (F.col("run_seq_id") >= F.col("_run")) & (F.col("run_seq_id") <= F.col("_run"))
    for k in own_type:
        on = on & (F.col("je_type") >= F.col(k)) & (F.col("je_type") <= F.col(k))
    return lines.join(chosen, on).select(*LINE_COLUMNS, "biller_run_date", *carried)


def total_picks(t: Tables, relations: DataFrame, run: int | None = None) -> DataFrame:
    """The picks of totals among lines of `relations`, and `ar_total`: the receivable total of the run's invoice, whole.

    Picks and totals are made of the same rows of the digest, so that they move once for both.
    """
    per_relation = digest_of(t, run).filter(F.col("je_type") == TOTAL).groupBy("run_seq_id", *RELATION_KEYS).agg(
        F.min("first_line").alias("first_line"), F.max("run_date").alias("biller_run_date"), F.sum("total").alias("total")
    )
    known = relations.select("billing_rel_id").distinct().withColumn("taking_part", F.lit(True))
    pick = F.col("taking_part") & F.col("first_line").isNotNull()
    per_invoice = per_relation.join(known, "billing_rel_id", "left").groupBy("run_seq_id", "invoice_prefix_seq_id").agg(
        F.min(F.when(pick, F.struct("first_line", "billing_rel_id", "biller_run_date"))).alias("lowest"),
        F.sum("total").cast("decimal(20,6)").alias("ar_total"),
    )
    return per_invoice.filter(F.col("lowest").isNotNull()).select(
        "run_seq_id", "invoice_prefix_seq_id", "lowest.billing_rel_id", "lowest.first_line", "lowest.biller_run_date", "ar_total"
    )


def representative_lines(
    t: Tables, je_type: str, run: int | None = None, relations: DataFrame | None = None
) -> DataFrame:
    """The open line with the lowest id of each relation (of each invoice for totals), in the interface's ledger."""
    return picked_lines(t, representative_picks(t, je_type, run, relations), je_type)
