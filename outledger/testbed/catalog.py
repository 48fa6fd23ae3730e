"""Registered queries: an operator on the adapter's tables, and the statement that checks it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from outledger.functions import rules, text
from outledger import schemas
from outledger.operators import branches, changes, drivers, journal, ledger, people, rollup
from outledger.operators.counterparty import counterparties, primary_contact
from outledger.plans import outbound as job
from outledger.runtime import checkpoint_dir
from outledger.sources import files
from outledger.sources.jdbc import environment_options, rows_as_text
from outledger.sources.tables import Source, load_tables
from outledger.testbed import checks
from outledger.testbed.adapter import Adapter, billing_tables

# The adapter's data has rejects on purpose.
PARAMS = job.Params(checks.POP_SITE, checks.OTHER_SITE, fail_on_rejects=False, placed=True)
AS_OF = date.fromisoformat(checks.AS_OF)
RELATION = ["run_seq_id", "invoice_prefix_seq_id", "billing_rel_id"]


@dataclass(frozen=True)
class Query:
    run: Callable[[Adapter], DataFrame]
    sql: str


QUERIES: dict[str, Query] = {}


def query(sql: str):
    def register(function: Callable[[Adapter], DataFrame]):
        QUERIES[function.__name__] = Query(function, sql)
        return function

    return register


def report(df: DataFrame) -> DataFrame:
    """Printable types: decimals as doubles and timestamps as text, the arithmetic being done."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _journal(t: Adapter) -> DataFrame:
    """The plain view: every line, repeated for every VAT and HEADER line."""
    return journal.outbound_journal(
        t, counterparties(t), checks.POP_SITE, checks.OTHER_SITE, expanded=True
    )


def _parts(t: Adapter) -> job.Prepared:
    """Heads, relations, receivable rows and charges, shared by the queries of a session."""
    if "job" not in t.__dict__:
        t["je_source"]
        t.job = job.prepare(t, PARAMS)
    return t.job


DETAIL = [
    *RELATION, "rate_percentage", "kind", "seq", "line_no", "row_account", "trading_partner",
    "rate_text", "quantity", "unit_price", "amount",
]


def _detail_sql(where: str) -> str:
    return f"""select run_seq_id, invoice_prefix_seq_id, billing_rel_id,
        rate_percentage::double as rate_percentage, kind, seq, line_no, row_account, trading_partner,
        rate_text, quantity, unit_price::double as unit_price, amount::double as amount
        from {{details}} where {where}"""


# --- aggregates and drivers ---------------------------------------------------------------------


@query("""select invoice_prefix_seq_id, billing_rel_id, rate_percentage::double as rate_percentage,
    item::double as item, vat::double as vat, service_desc from {rollup}""")
def rate_rollup(t):
    return rollup.rate_rollup(t["invoice_line"], placed=True)


@query("select run_seq_id, country_id, file_country from {countries}")
def countries_in_run(t):
    return drivers.countries_in_run(t)


@query("""select run_seq_id, invoice_prefix_seq_id, serv_desc, sending_gl, brin_reference_id,
    use_global_cust_site, ccl_bill_to_site, document_number, country_id, file_country from {invoices}""")
def invoices_in_run(t):
    return drivers.invoices_in_run(t, counterparties(t))


@query("""select distinct run_seq_id, invoice_prefix_seq_id, billing_rel_id from {je_line}
    where je_type = 'REC' and brin_op_gl = 'CCL' and coalesce(shadow_ind, 'N') = 'N'""")
def relations_of_invoices(t):
    return drivers.relations_of_invoices(t)


@query("""select run_seq_id, invoice_prefix_seq_id, count(*) as relations, min(je_line_seq_id) as first_line,
    max(je_line_seq_id) as last_line from {rec_rep} x where exists (select 1 from {heads} h
        where h.run_seq_id = x.run_seq_id and h.invoice_prefix_seq_id = x.invoice_prefix_seq_id)
    group by all""")
def representative_relations(t):
    lines = _parts(t).relations
    return lines.groupBy("run_seq_id", "invoice_prefix_seq_id").agg(
        F.count("*").alias("relations"),
        F.min("je_line_seq_id").alias("first_line"),
        F.max("je_line_seq_id").alias("last_line"),
    )


@query("""select run_seq_id, invoice_prefix_seq_id, billing_rel_id, je_line_seq_id, gl_account,
    billing_amt::double as billing_amt from (
        select je.*, row_number() over (partition by je.run_seq_id, invoice_prefix_seq_id,
            billing_rel_id order by je_line_seq_id) as rn
        from {je_line} je join {run} r on je.run_seq_id = r.run_seq_id
            and created_on between run_date - interval 1 day and run_date + interval 1 day
        where je_type = 'REC' and brin_op_gl = 'CCL' and coalesce(shadow_ind, 'N') = 'N')
    where rn = 1""")
def representative_line(t):
    picked = journal.representative_lines(t, "REC")
    return picked.select(*RELATION, "je_line_seq_id", "gl_account", "billing_amt")


@query("""select run_seq_id, invoice_prefix_seq_id, ar_total::double as ar_total from {ar_totals}""")
def ar_total_per_invoice(t):
    return rollup.ar_totals(t["je_line"])


# --- joins --------------------------------------------------------------------------------------


@query("""select je_line_seq_id, je_type, strftime(created_on, '%Y-%m-%d %H:%M:%S') as created_on,
    strftime(run_date, '%Y-%m-%d %H:%M:%S') as biller_run_date from {je_line} je join {run} r
    on je.run_seq_id = r.run_seq_id and created_on between run_date - interval 1 day and run_date + interval 1 day
    where length(brin_op_gl) = 3 and coalesce(shadow_ind, 'N') = 'N' and je_type in ('REC', 'TP', 'AR')""")
def journal_run_window(t):
    return journal.outbound_lines(t).select(
        "je_line_seq_id", "je_type", "created_on", "biller_run_date"
    )


@query("""select je_line_seq_id, vat_line_seq_id, je_type, bex_je_description, orig_gl_account,
    seller_cost_center, product_line, product_line_tp, sbx_commodity_code from {v}""")
def conditional_on_left_join(t):
    return _journal(t).select(
        "je_line_seq_id", "vat_line_seq_id", "je_type", "bex_je_description", "orig_gl_account",
        "seller_cost_center", "product_line", "product_line_tp", "sbx_commodity_code",
    )


@query("""select je_line_seq_id, vat_line_seq_id, account_vat, sabrix_tax_type
    from (from {je_line} where je_type = 'REC') left join {vat_lines}
        using (invoice_prefix_seq_id, billing_rel_id)""")
def self_join_vat_line(t):
    rec = t["je_line"].filter(F.col("je_type") == "REC").select(
        "invoice_prefix_seq_id", "billing_rel_id", "je_line_seq_id"
    )
    return journal.vat_pairs(t, rec).expanded().select(
        "je_line_seq_id", "vat_line_seq_id", "account_vat", "sabrix_tax_type"
    )


@query("""select l.in_sending_gl, l.vat_percentage::double as vat_percentage, count(*) as pairs,
    sum(l.billing_amt)::double as billing_amt, sum(v.billing_amt)::double as vat_amt
    from (from {je_line} where je_type = 'REC') l left join (from {je_line} where je_type = 'VAT') v
        using (invoice_prefix_seq_id, billing_rel_id) group by all""")
def vat_pair_totals(t):
    rec = t["je_line"].filter(F.col("je_type") == "REC").select(
        "invoice_prefix_seq_id", "billing_rel_id", "in_sending_gl", "vat_percentage", "billing_amt"
    )
    return journal.vat_pairs(t, rec).totals(["in_sending_gl", "vat_percentage"], ("billing_amt",), ("vat_amt",))


@query("""select * replace (consumption_per::double as consumption_per,
    max_unit_price::double as max_unit_price) from {cp}""")
def role_playing_dims(t):
    return counterparties(t)


@query("select pl_seq_id, user_seq_id, plcontact from {contact}")
def primary_contacts(t):
    return primary_contact(t["pl_contact"], t["app_user"])


@query("""select * replace (original_amt::double as original_amt, invoice_amount::double as invoice_amount,
    strftime(biller_run_date, '%Y-%m-%d %H:%M:%S') as biller_run_date,
    vat_percentage::double as vat_percentage, tp_percentage::double as tp_percentage,
    consumption_per::double as consumption_per, max_unit_price::double as max_unit_price) from {v}""")
def outbound_journal(t):
    return _journal(t)


@query("select cost_center, product_line from {first_line}")
def dedup_dimension(t):
    return journal.product_line(t["cost_center"])


@query("""select acct_number, max(tp_required) as tp_required from {gl_account} where is_active = 'Y'
    group by all""")
def tp_flag(t):
    return journal.tp_flag(t["gl_account"])


@query("""select je_line_seq_id, je_type, gl_account from {je_line} where upper(gl_account) in
    (select acct_number from {members})""")
def tp_membership(t):
    member = F.upper("gl_account") == F.col("acct_number")
    return (
        t["je_line"]
        .join(journal.tp_accounts(t["gl_account"]), member, "left_semi")
        .select("je_line_seq_id", "je_type", "gl_account")
    )


@query("""select (place - 1) // 50 as part, string_agg(acct_number, ',' order by acct_number) as accounts
    from (select acct_number, row_number() over (order by acct_number) as place from {members}) group by all""")
def account_list(t):
    return rollup.account_texts(journal.tp_accounts(t["gl_account"]), part_rows=50)


@query("""select distinct run_seq_id, document_number, brin_reference_id
    from {asked} asked join (from {invoice_country} where file_country = 'RU') using (invoice_prefix_seq_id)
    where exists (from {invoice_line} b where b.run_seq_id = asked.run_seq_id
            and b.invoice_prefix_seq_id = asked.invoice_prefix_seq_id)
        and asked.run_seq_id in (select run_seq_id from {countries} where file_country = 'RU')
        and not exists (from {contracts} k where k.reference_id = asked.brin_reference_id
            and k.contract_number is not null)""")
def missing_contracts(t):
    return drivers.missing_contracts(t)


@query("""select run_seq_id, invoice_prefix_seq_id, file_country, brin_reference_id, contract_number,
    contract_missing, customer_site, site_missing from {sited}""")
def contracts_and_sites(t):
    invoices = drivers.invoices_in_run(t, counterparties(t))
    contracted = drivers.contract_number(invoices, t["contracts"])
    return drivers.customer_site(contracted, t["customer_site"]).select(
        "run_seq_id", "invoice_prefix_seq_id", "file_country", "brin_reference_id",
        "contract_number", "contract_missing", "customer_site", "site_missing",
    )


@query("""select je.je_line_seq_id, je.gl_account as expense_account, e.look_name as exception_account
    from {je_line} je left join {exceptions} e on e.je_category = je.je_line_type_cat
        and e.sub_category = je.je_line__type_sub_cat
        and e.sub_sub_category = je.je_line_type_sub_sub_cat and e.je_tax = je.je_line_tax_type
        and e.je_interco = je.je_line_type_interco and e.look_code = je.gl_account""")
def account_exception(t):
    lines = t["je_line"].select(
        "je_line_seq_id", F.col("gl_account").alias("expense_account"), "je_line_type_cat",
        F.col("je_line__type_sub_cat").alias("expense_category"), "je_line_type_sub_sub_cat",
        "je_line_tax_type", "je_line_type_interco",
    )
    known = branches.account_exceptions(t["look_up"], t["je_line_type"])
    return branches.with_exception(lines, known).select(
        "je_line_seq_id", "expense_account", "exception_account"
    )


@query("""select c.run_seq_id, c.invoice_prefix_seq_id, c.billing_rel_id, s.sabrix_tax_type
    from (select distinct run_seq_id, invoice_prefix_seq_id, billing_rel_id from {je_line}) c
    left join {vat_gst} s on s.billing_rel_id = c.billing_rel_id and s.vat_gst_type = 'SELLER'""")
def seller_tax_type(t):
    relations = t["je_line"].select(*RELATION).distinct()
    return relations.join(journal.seller_tax_types(t), "billing_rel_id", "left")


# --- texts --------------------------------------------------------------------------------------


@query("""select je_line_seq_id, min(ime) as ime, min(ile) as ile from {v} group by all""")
def ime_ile(t):
    one = journal.enrich(
        journal.outbound_lines(t), t, counterparties(t), checks.POP_SITE, checks.OTHER_SITE,
        one_vat_line=True,
    )
    return one.select("je_line_seq_id", "ime", "ile")


@query("""select i.invoice_prefix_seq_id, concat(nickname, invoice_type, '-', lst_invoice_nbr) as invoice_number,
    case h.settlement_type when 'IBS' then concat('IBS  ', from_buc, ' ', to_buc)
        when 'NON-IBS' then concat('Due upon receipt.  Please send payment directly to our bank. ', bic, ' ', iban)
        else 'NON IBS, ACA' end as invoice_header,
    case when l.tax_comp_amt + l.ntax_comp_amt < 0 then 'CM' else 'INV' end as document_type
    from {invoice_prefix} i join {invoice_header} h on h.invoice_prefix_seq_id = i.invoice_prefix_seq_id
    join {invoice_line} l on l.invoice_prefix_seq_id = i.invoice_prefix_seq_id and l.inv_line_type = 'HEADER'""")
def invoice_text(t):
    return journal.invoice_facts(t).select(
        "invoice_prefix_seq_id", "invoice_number", "invoice_header",
        rules.document_type(F.col("invoice_amount")).alias("document_type"),
    )


@query(f"""select je_line_seq_id, {checks.money('billing_amt')} as amount_text,
    {checks.percent('coalesce(vat_percentage, 0)')} as rate_text,
    {checks.percent('tp_percentage')} as short_text from {{je_line}}""")
def money_text(t):
    return t["je_line"].select(
        "je_line_seq_id",
        text.money_text(F.col("billing_amt")).alias("amount_text"),
        text.rate_text(F.col("vat_percentage")).alias("rate_text"),
        text.short_percent_text(F.col("tp_percentage")).alias("short_text"),
    )


# --- records ------------------------------------------------------------------------------------


@query("""select run_seq_id, invoice_prefix_seq_id, billing_rel_id,
    rate_percentage::double as rate_percentage, account from {charged} where country_code = 'MX'""")
def account_override_mx(t):
    return _parts(t).charges.filter(F.col("country_code") == "MX").select(
        *RELATION, "rate_percentage", "account"
    )


@query("""select run_seq_id, invoice_prefix_seq_id, billing_rel_id,
    rate_percentage::double as rate_percentage, account, trading_partner from {charged}""")
def trading_partner(t):
    return _parts(t).charges.select(*RELATION, "rate_percentage", "account", "trading_partner")


@query("""select run_seq_id, invoice_prefix_seq_id, billing_rel_id,
    rate_percentage::double as rate_percentage, line_start from {numbered}""")
def line_numbers(t):
    return _parts(t).numbered.select(*RELATION, "rate_percentage", "line_start")


@query(f"""select run_seq_id, invoice_prefix_seq_id, file_country, expense_account, trading_partner,
    product_line, ar_total::double as ar_total, {checks.REC_TEXT} as description,
    {checks.descriptor("je_type = 'AR'")} as descriptor from {{recs}}""")
def rec_records(t):
    c = F.col
    word = job.add_lookup(_parts(t).recs, t["look_up"], PARAMS.local_word_key, "local_word")
    return word.select(
        "run_seq_id", "invoice_prefix_seq_id", "file_country", "expense_account",
        "trading_partner", "product_line", "ar_total",
        rules.rec_description(
            c("country_code"), c("sending_gl"), c("reference_id"), c("serv_desc"), c("local_word")
        ).alias("description"),
        rules.descriptor(c, c("je_type") == "AR").alias("descriptor"),
    )


@query(_detail_sql("country_code not in ('CN', 'IN', 'CO')"))
def revtax_default(t):
    return branches.revtax_default(_parts(t).numbered).select(*DETAIL)


@query(_detail_sql("country_code = 'IN'"))
def revtax_in(t):
    return branches.revtax_in(_parts(t).numbered).select(*DETAIL)


@query(_detail_sql("country_code = 'CN'"))
def revtax_cn(t):
    return branches.revtax_cn(_parts(t).numbered).select(*DETAIL)


@query(_detail_sql("country_code = 'CO'"))
def revtax_co(t):
    return branches.revtax_co(_parts(t).numbered).select(*DETAIL)


@query("""select d.run_seq_id, d.file_country, strftime(s.run_on, '%Y%m') as run_month,
    coalesce(n.n_rows, 0) as n_rows, case when e.site_error then 'test' else w.run_mode end as run_type,
    concat('BILCCL,CCLARINVES,', strftime(s.run_on, '%Y%m'), '15,TRAILER,', coalesce(n.n_rows, 0), ',',
        case when e.site_error then 'test' else w.run_mode end) as line
    from {countries} d
    left join {outbound_summary} s on s.run_seq_id = d.run_seq_id and s.gl_identifier = 'CCA'
    left join (select run_seq_id, country_id, count(*) as n_rows from {made} group by all) n
        on n.run_seq_id = d.run_seq_id and n.country_id = d.country_id
    left join (select run_seq_id, country_id, bool_or(site_missing) as site_error from {heads} group by all) e
        on e.run_seq_id = d.run_seq_id and e.country_id = d.country_id
    cross join {words} w""")
def trailer(t):
    return job.trailers_of(t, _parts(t), PARAMS)


@query("""select r.run_seq_id, r.invoice_prefix_seq_id, r.billing_rel_id,
    null::double as rate_percentage, 'no journal line' as reason
    from (select distinct run_seq_id, invoice_prefix_seq_id, billing_rel_id from {je_line}
        where je_type = 'REC' and brin_op_gl = 'CCL' and coalesce(shadow_ind, 'N') = 'N') r
    join {heads} h on h.run_seq_id = r.run_seq_id and h.invoice_prefix_seq_id = r.invoice_prefix_seq_id
    left join {rec_rep} x on x.run_seq_id = r.run_seq_id
        and x.invoice_prefix_seq_id = r.invoice_prefix_seq_id and x.billing_rel_id = r.billing_rel_id
    where x.je_line_seq_id is null
    union all
    select run_seq_id, invoice_prefix_seq_id, billing_rel_id, rate_percentage::double,
        'tax rate without a rule' from {charged} where country_code = 'IN' and (seller_vat_regime <> 'Y'
        or coalesce(rate_percentage, 0) not in (0, 0.09, 0.1236, 0.14, 0.145, 0.15, 0.18))""")
def rejects(t):
    return job.rejects_of(t, _parts(t))


@query("""select run_seq_id, file_country, country_code, invoice_prefix_seq_id, billing_rel_id,
    rate_percentage::double as rate_percentage, kind, seq, line_no, account, quantity,
    unit_price::double as unit_price, amount::double as amount, line from {made}""")
def outbound_lines(t):
    return job.outbound(t, PARAMS).records.drop("line_start")


TRAILER = """concat('BILCCL,CCLARINVES,', strftime(s.run_on, '%Y%m'), '15,TRAILER,', coalesce(n.n_rows, 0), ',',
    case when e.site_error then 'test' else w.run_mode end)"""


@query(f"""select run_seq_id, file, row_number() over (partition by run_seq_id, file order by part,
        invoice_prefix_seq_id, kind <> 'REC', billing_rel_id, rate_percentage nulls last, seq) as file_line, value
    from (
        select run_seq_id, concat('AR.', file_country, '-', strftime(date '{checks.AS_OF}', '%d%b%y')) as file, 0 as part,
            invoice_prefix_seq_id, kind, billing_rel_id, rate_percentage, seq, line as value from {{made}}
        union all
        select d.run_seq_id, concat('AR.', d.file_country, '-', strftime(date '{checks.AS_OF}', '%d%b%y')), 1, null,
            null, null, null, null, {TRAILER}
        from {{countries}} d
        left join {{outbound_summary}} s on s.run_seq_id = d.run_seq_id and s.gl_identifier = 'CCA'
        left join (select run_seq_id, country_id, count(*) as n_rows from {{made}} group by all) n
            on n.run_seq_id = d.run_seq_id and n.country_id = d.country_id
        left join (select run_seq_id, country_id, bool_or(site_missing) as site_error from {{heads}} group by all) e
            on e.run_seq_id = d.run_seq_id and e.country_id = d.country_id
        cross join {{words}} w)""")
def file_lines(t):
    """All files written in parts and read back line by line."""
    path = f"{checkpoint_dir(t.spark)}/files-{uuid.uuid4().hex}"
    made_of = _parts(t)
    records, trailers = job.records_of(t, made_of, PARAMS), job.trailers_of(t, made_of, PARAMS)
    parts = files.write_outbound(records, trailers, "AR", AS_OF, path, part_lines=500)
    return files.read_lines(t.spark, path, parts)


# --- small tables -------------------------------------------------------------------------------


@query(f"""select first_name, department_name from {{employees}} e
    join {{departments}} d on e.department_id = d.department_id
    where month(hire_date) = month(date '{checks.AS_OF}')""")
def anniversaries(t):
    return people.anniversaries(t["employees"], t["departments"], AS_OF)


@query("""select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
    union all select s_suppkey + 1000000, s_name, null, null, null from supplier""")
def dml_insert(t):
    rows = t["supplier"].select(
        (F.col("s_suppkey") + 1000000).alias("c_custkey"), F.col("s_name").alias("c_name")
    )
    return changes.insert_rows(t["customer"], rows)


@query("""select case when c_acctbal < 0 then c_custkey + 5000000 else c_custkey end as c_custkey,
    case when c_acctbal < 0 then 'moved ' || c_custkey else c_name end as c_name, c_nationkey,
    c_acctbal, c_mktsegment from customer""")
def dml_update(t):
    owes = F.col("c_acctbal") < 0
    values = {
        "c_custkey": F.col("c_custkey") + 5000000,
        "c_name": F.concat(F.lit("moved "), F.col("c_custkey").cast("string")),
    }
    return changes.update_rows(t["customer"], owes, values)


def _segment_seen():
    """NULL for the unknown balances that the delete must keep."""
    return F.when(F.col("c_acctbal") > 1000, F.col("c_mktsegment") == "BUILDING")


@query("""select * from customer where (case when c_acctbal > 1000 then c_mktsegment = 'BUILDING' end)
    is not true""")
def dml_delete(t):
    return changes.delete_rows(t["customer"], _segment_seen())


@query("""with inserted as (select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
        union all select s_suppkey + 1000000, s_name, null, null, null from supplier),
    updated as (select case when c_mktsegment = 'MACHINERY' then c_custkey + 7 else c_custkey end as c_custkey,
        case when c_mktsegment = 'MACHINERY' then 'x' else c_name end as c_name, c_nationkey, c_acctbal,
        c_mktsegment from inserted)
    select * from updated where (c_acctbal < 100) is not true""")
def dml_change_set(t):
    rows = t["supplier"].select(
        (F.col("s_suppkey") + 1000000).alias("c_custkey"), F.col("s_name").alias("c_name")
    )
    values = {"c_custkey": F.col("c_custkey") + 7, "c_name": F.lit("x")}
    steps = [
        changes.Change("V4__delete_poor", "c", lambda d: changes.delete_rows(d, F.col("c_acctbal") < 100)),
        changes.Change("V3__update_segment", "c", lambda d: changes.update_rows(
            d, F.col("c_mktsegment") == "MACHINERY", values)),
        changes.Change("V2__insert_suppliers", "c", lambda d: changes.insert_rows(d, rows)),
    ]
    return changes.apply_changes({"c": t["customer"]}, steps)["c"]


@query("""with inserted as (select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer
        union all select s_suppkey + 1000000, s_name, null, null, null from supplier),
    updated as (select case when c_mktsegment = 'MACHINERY' then c_custkey + 7 else c_custkey end as c_custkey,
        case when c_mktsegment = 'MACHINERY' then 'BUILDING' else c_mktsegment end as c_mktsegment, c_name,
        c_nationkey, c_acctbal from inserted)
    select * from updated where (c_mktsegment = 'HOUSEHOLD' and c_acctbal < 5000) is not true""")
def dml_stored(t):
    """Versioned changes of a table in folders by segment, applied through its ledger and read back."""
    root = f"{checkpoint_dir(t.spark)}/stored-{uuid.uuid4().hex}"
    customer = t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    ledger.create_stored(customer, root, "c", ["c_mktsegment"])
    rows = t["supplier"].select((F.col("s_suppkey") + 1000000).alias("c_custkey"), F.col("s_name").alias("c_name"))
    moved = F.col("c_mktsegment") == "MACHINERY"
    poor = (F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_acctbal") < 5000)
    values = {"c_custkey": F.col("c_custkey") + 7, "c_mktsegment": F.lit("BUILDING")}
    steps = [
        ledger.StoredChange("V4__delete", "c", lambda d: changes.delete_rows(d, poor), poor, "delete"),
        ledger.StoredChange("V2__insert", "c", lambda d: changes.insert_rows(d, rows), text="insert"),
        ledger.StoredChange("V3__update", "c", lambda d: changes.update_rows(d, moved, values), moved, "update"),
    ]
    ledger.apply_stored(t.spark, root, {"c": customer.schema}, {"c": ["c_mktsegment"]}, steps)
    return ledger.read_stored(t.spark, root, "c", customer.schema)


@query("""select cast(c_custkey as integer) as id, left(c_name, 20) as name, cast(c_nationkey as integer) as age
    from customer""")
def created_table(t):
    """Rows of a table created with its types, NOT NULL columns and lengths."""
    name = f"customers_{uuid.uuid4().hex}"
    rows = t["customer"].select(
        F.col("c_custkey").alias("id"), F.left("c_name", F.lit(20)).alias("name"), F.col("c_nationkey").alias("age")
    )
    changes.create_table(rows, name, schemas.struct("customers"))
    return t.spark.table(name)


@query("""select e.first_name, e.department_id, strftime(e.hire_date, '%Y-%m-%d %H:%M:%S') as hire_date,
    d.department_name from {employees} e left join {departments} d using (department_id)""")
def loaded_tables(t):
    """Tables found by name: one in a folder of Parquet tables, one in the catalog, the folder by environment."""
    folder = f"{checkpoint_dir(t.spark)}/load-{uuid.uuid4().hex}"
    t["employees"].write.parquet(f"{folder}/T_EMPLOYEES")
    name = f"departments_{uuid.uuid4().hex}"
    t["departments"].write.saveAsTable(name)
    environments = {"UAT": {"location": "/nowhere"}, "Test": {"location": folder}}
    found = environment_options(environments, "tEST")["location"]
    sources = {
        "billing": Source("parquet", found, names={"employees": "T_EMPLOYEES"}),
        "second": Source("catalog", names={"departments": name}),
    }
    tables = load_tables(t.spark, sources, ["employees", "departments"], placed={"departments": "second"})
    return tables["employees"].join(tables["departments"], "department_id", "left").select(
        "first_name", "department_id", "hire_date", "department_name"
    )


@query("""select concat_ws(' ', n_nationkey, trim(n_name), n_regionkey, trim(c_name), c_custkey) as value
    from customer join nation on c_nationkey = n_nationkey""")
def rows_text(t):
    joined = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    return rows_as_text(
        joined.select("n_nationkey", "n_name", "n_regionkey", "c_name", "c_custkey")
    )


@query("""select o.o_orderkey, n.n_regionkey as value from orders o cross join
    (select max(cast(n_regionkey as varchar)) as n_regionkey from nation where n_name = 'NATION_7') n""")
def lookup_value(t):
    names = t["nation"].select(
        F.lit("NATION").alias("type"), F.col("n_name").alias("look_code"),
        F.lit("REGION").alias("look_name"), F.col("n_regionkey").cast("string").alias("value"),
    )
    return job.add_lookup(
        t["orders"].select("o_orderkey"), names, ("NATION", "NATION_7", "REGION"), "value"
    )


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return report(QUERIES[name].run(billing_tables(spark, folder)))

    return run


def check_statement(name: str) -> str:
    return checks.with_blocks(QUERIES[name].sql)
