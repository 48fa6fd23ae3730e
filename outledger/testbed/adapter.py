"""Billing tables derived from the driver's tables.

One SQL text per table, in the part of the language that Spark and DuckDB share, so that queries
and their SQL checks start from the same rows. `{name}` stands for another table of this module or
for a driver table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from outledger import schemas
from outledger.operators import journal
from outledger.runtime import bucketed, materialize, shuffle_partitions

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

COUNTRY_DIGIT = """case {k} % 10 when 0 then 0 when 1 then 1 when 2 then 2 when 3 then 3 when 4 then 4
    when 5 then 0 when 6 then 1 when 7 then 7 when 8 then 8 else 4 end"""
COUNTRY = """case {k} % 10 when 0 then 'CN' when 1 then 'IN' when 2 then 'CO' when 3 then 'MX'
    when 4 then 'US' when 5 then 'CN' when 6 then 'IN' when 7 then 'RU' when 8 then 'AR' else 'US' end"""


def _country(key: str) -> str:
    return COUNTRY.replace("{k}", key)


def _digit(key: str) -> str:
    return COUNTRY_DIGIT.replace("{k}", key)


def _text(expr: str) -> str:
    return f"cast({expr} as string)"


def _padded(expr: str, width: int) -> str:
    return f"lpad(cast({expr} as string), {width}, '0')"


SENDER = "case ck % 8 when 0 then 'AHB' when 1 then 'ARS' when 2 then 'ESB' else 'CCX' end"
REFERENCE = f"case when ck % 6 = 0 then null else 'REF' || {_text('ck')} end"
ACCOUNT = f"'4' || {_padded('pk % 1200', 9)}"
SELLER_SEGMENT = f"""case when sk % 3 = 0 then 'S' || {_padded('sk % 1000', 3)}
    else 'G' || {_padded('sk', 5)} || 'L' || {_padded('sk', 5)} end"""
BUYER_SEGMENT = f"""case when ck % 3 = 0 then 'T' || {_padded('ck % 1000', 3)}
    else 'H' || {_padded('ck', 5)} || 'M' || {_padded('ck', 5)} end"""
TYPE_COLUMNS = f"""
    case pk % 12 when 0 then 'CRE001' when 1 then 'CRE002' else 'JT' || {_text('pk % 12')} end
        as je_line_type_id,
    case when pk % 12 in (1, 6, 7, 8) then 'AP' when pk % 12 = 9 then 'BEX' else 'AR' end
        as je_line_type_cat,
    case pk % 12 when 0 then 'ACA' when 1 then 'ACA' when 2 then 'DR4' when 3 then 'ACA'
        when 4 then 'ESB' when 5 then 'OTH' when 6 then 'DR4' when 7 then 'ACA' when 8 then 'OTH'
        when 9 then 'ESB' when 10 then 'IBS' else null end as je_line__type_sub_cat,
    'SS' || {_text('pk % 12 % 5')} as je_line_type_sub_sub_cat,
    'TX' || {_text('pk % 12 % 3')} as je_line_tax_type,
    case pk % 12 % 5 when 0 then 'OOB' when 1 then 'WOB' when 2 then 'GEC' when 3 then 'EXT'
        else 'OTH' end as je_line_type_interco"""


def _journal(
    je_type: str, digit: int, source: str, amount: str, line: str, table: str,
    account: str = ACCOUNT, sub_category: str | None = None, where: str = "",
    shadow: str = "cast(null as string)", created: str = "od",
) -> str:
    types = TYPE_COLUMNS
    if sub_category:
        start = types.index("case pk % 12 when 0 then 'ACA'")
        end = types.index(" as je_line__type_sub_cat")
        types = types[:start] + sub_category + types[end:]
    return f"""
    select run as run_seq_id, inv as invoice_prefix_seq_id,
        (ok * 10000000 + sk) * 100 + {line} * 10 + {digit} as je_line_seq_id,
        {source} as src_je_line_seq_id, rel as billing_rel_id, '{je_type}' as je_type,
        {SENDER} as in_sending_gl,
        case when sk % 23 = 22 and ok % 3 = 0 then 'CCLX' when ok % 29 = 0 then 'CCA' else 'CCL' end
            as brin_op_gl,
        'B' || {_padded('sk', 5)} || 'L' || {_padded('ck', 5)} as brin_balancing_segment,
        {REFERENCE} as brin_reference_id,
        case when pk % 10 = 9 then null else 'CC' || {_padded('pk % 500', 4)} end as brin_cost_center,
        case pk % 3 when 0 then null when 1 then ' PRJ' || {_text('pk % 50')} || ' ' else 'PROJECT' end
            as project,
        case pk % 4 when 0 then 'Buyer' when 1 then 'SELLER' when 2 then 'seller' else null end
            as outbound_id,
        {_country('sk')} || 'D' as billing_curr,
        cast({amount} as decimal(20,6)) as billing_amt,
        cast({line} as bigint) as run_rec_number,
        {account} as gl_account, {types},
        rate as vat_percentage,
        case when pk % 5 = 0 then null else cast(0.05 as decimal(12,6)) end as tp_percentage,
        'T' as tp_type, case when pk % 2 = 0 then 'Y' else 'N' end as is_taxable,
        case when pk % 13 = 0 then null else 'D1|two-' || {_text('pk')} || '|three, part||contact-'
            || {_text('ck')} || '@mail.test|  six|  seven' end as in_je_description,
        case when pk % 7 = 0 then null else 'SV' || {_text('pk % 100')} end as service_code,
        {shadow} as shadow_ind, {created} as created_on
    from {{{table}}} {where}"""


SQL: dict[str, str] = {
    "billed": f"""
        select *, cast(item * rate as decimal(20,6)) as vat from (
            select l_orderkey as ok, l_suppkey as sk, l_partkey as pk, l_linenumber as ln,
                o_custkey as ck, o_orderdate as od,
                cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)
                    as bigint) as run,
                l_orderkey * 10 + {_digit('l_suppkey')} as inv,
                l_suppkey * 10000000 + o_custkey as rel,
                cast(cast(case when l_returnflag = 'R' then -1 else 1 end as decimal(1,0))
                    * cast(l_extendedprice as decimal(12,2))
                    * (cast(1 as decimal(3,2)) - cast(l_discount as decimal(3,2)))
                    as decimal(20,6)) as item,
                case when l_suppkey % 10 in (1, 6) then
                    case cast(cast(l_tax as decimal(4,2)) * 100 as int)
                        when 0 then cast(0 as decimal(12,6)) when 1 then cast(0.09 as decimal(12,6))
                        when 2 then cast(0.1236 as decimal(12,6)) when 3 then cast(0.14 as decimal(12,6))
                        when 4 then cast(0.145 as decimal(12,6)) when 5 then cast(0.15 as decimal(12,6))
                        when 8 then cast(0 as decimal(12,6)) else cast(0.18 as decimal(12,6)) end
                    else cast(cast(l_tax as decimal(4,2)) as decimal(12,6)) end as rate
            from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey) b""",
    # (order, line number) is not unique, so equal keys of a supplier are added up.
    "entry": """
        select ok, sk, ln, min(ck) as ck, min(od) as od, min(run) as run, min(inv) as inv,
            min(rel) as rel, min(pk) as pk, cast(sum(item) as decimal(20,6)) as item,
            cast(sum(vat) as decimal(20,6)) as vat, max(rate) as rate
        from {billed} group by ok, sk, ln""",
    "settled": """
        select ok, sk, min(ck) as ck, min(od) as od, min(run) as run, min(inv) as inv,
            min(rel) as rel, min(pk) as pk, cast(sum(item) as decimal(20,6)) as item,
            cast(sum(vat) as decimal(20,6)) as vat, max(rate) as rate
        from {billed} group by ok, sk""",
    "invoice": f"""
        select inv, min(ok) as ok, min(sk) as sk, min(ck) as ck, min(run) as run,
            cast(sum(item) as decimal(20,6)) as item, cast(sum(vat) as decimal(20,6)) as vat
        from {{billed}} group by inv""",
    "je_line": " union all ".join(
        [
            _journal("INC", 1, "cast(null as bigint)", "item", "ln", "entry"),
            _journal(
                "REC", 2, "(ok * 10000000 + sk) * 100 + ln * 10 + 1", "item", "ln", "entry",
                shadow="case ln % 4 when 0 then 'Y' when 1 then 'N' else null end",
                created="""case when ln = 7 then od + interval '2' day
                    when ln = 6 then od + interval '1' day else od end""",
            ),
            _journal(
                "VAT", 3, "cast(null as bigint)", "vat", "ln", "entry",
                account=f"'2076' || {_padded('pk % 900', 6)}",
                sub_category="case pk % 4 when 0 then 'IGS' when 1 then 'cgs' when 2 then 'SGS' else 'OTH' end",
                where="where sk % 6 <> 0",
            ),
            _journal("AR", 4, "cast(null as bigint)", "item + vat", "0", "settled"),
            _journal("TP", 5, "cast(null as bigint)", "item", "0", "settled"),
        ]
    ),
    "run": """
        select distinct cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100
            + day(o_orderdate) as bigint) as run_seq_id, o_orderdate as run_date from {orders}""",
    "outbound_summary": """
        select run_seq_id, 'CCA' as gl_identifier, run_date as run_on from {run}
        union all select run_seq_id, 'CCL', run_date + interval '40' day from {run}""",
    "invoice_prefix": f"""
        select inv as invoice_prefix_seq_id, 'N' || {_country('sk')} as nickname,
            case when ok % 31 = 0 then 'M' else 'I' end as invoice_type,
            {_text('ok')} as lst_invoice_nbr, sk * 10 + 1 as pl_seq_id from {{invoice}}""",
    "invoice_header": f"""
        select inv as invoice_prefix_seq_id,
            case when ok % 4 = 0 then null else 'BR' || {_text('ok')} end as billing_ref,
            case ck % 3 when 0 then 'IBS' when 1 then 'NON-IBS' else 'OTH' end as settlement_type,
            'FB' || {_text('sk')} as from_buc, 'TB' || {_text('ck')} as to_buc,
            'BIC,' || {_text('ck % 100')} as bic,
            case when ck % 5 = 0 then null else 'IBAN' || {_text('ck')} end as iban
        from {{invoice}}""",
    "invoice_line": f"""
        select inv as invoice_prefix_seq_id, run as run_seq_id,
            cast(null as bigint) as brid_billing_rel_id, 'HEADER' as inv_line_type,
            cast(null as decimal(12,6)) as rate_percentage, vat as tax_comp_amt,
            item as ntax_comp_amt, cast(null as string) as service_desc,
            cast(null as string) as service_name_translated, {SENDER} as in_sending_gl
        from {{invoice}}
        union all
        select inv, run, rel, kind, case when kind = 'FEE' then cast(0.1 as decimal(12,6)) else rate end,
            case when kind = 'VAT' then vat else cast(0 as decimal(20,6)) end,
            case kind when 'ITEM' then item when 'FEE' then cast(5 as decimal(20,6))
                else cast(0 as decimal(20,6)) end,
            case when pk % 11 = 0 then null else p_name || ', ' || p_brand end,
            case when pk % 5 = 0 and kind <> 'VAT' then 'T-' || p_name else null end, {SENDER}
        from (
            select b.*, 'ITEM' as kind from {{billed}} b
            union all select b.*, 'VAT' as kind from {{billed}} b
            union all select b.*, 'FEE' as kind from {{billed}} b
                where ln = 1 and pk % 50 = 0 and sk % 10 not in (1, 6)) k
        join {{part}} on p_partkey = pk""",
    "gl_account": f"""
        select '4' || {_padded('p_partkey % 1200', 9)} as acct_number,
            case when p_size <= 15 then 'Y' when p_size <= 30 then 'T' else 'N' end as tp_required,
            case when p_partkey % 4 = 3 then 'N' else 'Y' end as is_active from {{part}}
        union all select distinct '4020601650', 'Y', 'Y' from {{region}}
        union all select distinct '4020201650', 'N', 'Y' from {{region}}""",
    "cost_center": f"""
        select 'CC' || {_padded('p_partkey % 500', 4)} as cost_center,
            case when p_partkey % 3 = 0 then null else p_type || '-' || {_text('p_size')} end
                as product_line from {{part}}""",
    "service": f"""
        select distinct 'SV' || {_text('p_partkey % 100')} as code,
            'HS' || {_text('p_partkey % 100')} as sbx_commodity_code,
            case when p_partkey % 100 % 9 = 0 then 'N' else 'Y' end as is_active_ind from {{part}}""",
    "billing_route": f"""
        select s_suppkey as billing_route_id, case when s_suppkey % 4 = 0 then 'POP' else 'STD' end
            as route_type, 'R' || {_text('s_suppkey')} as route_id, {_text('s_suppkey % 120')}
            as route_version, 'RB' || {_text('s_suppkey')} as buc,
            'ADN' || {_text('s_suppkey')} as adn from {{supplier}}""",
    "billing_rel": f"""
        select rel as billing_rel_id, sk as billing_route_id,
            'K' || {_text('sk % 7')} as relationship_ind,
            case when sk % 2 = 0 then null else cast(0.5 as decimal(12,6)) end as consumption_per,
            case when sk % 17 = 16 then null else 'S' end as seller_role,
            case when ck % 19 = 18 then null else 'B' end as buyer_role,
            case when ck % 3 = 0 then 'OTH' else 'IBS' end as settlement_type,
            sk * 10 + 7 as seller_pl_seq_id, ck * 10 + 8 as buyer_pl_seq_id,
            sk % 25 as seller_buc_id, case when ck % 10 = 3 then null else ck % 25 end as buyer_buc_id
        from (select distinct rel, sk, ck from {{billed}}) r""",
    "pl_his": """
        select s_suppkey * 10 + 7 as pl_his_id, s_suppkey * 10 + 1 as pl_seq_id,
            cast(s_nationkey as bigint) as mgmt_entity_his_id,
            1000 + s_suppkey % 10 as legal_entity_his_id from {supplier}
        union all
        select c_custkey * 10 + 8, c_custkey * 10 + 2, cast(c_nationkey as bigint),
            cast(c_nationkey as bigint) from {customer}""",
    "pl": f"""
        select sk * 10 + 1 as pl_seq_id, 1000 + sk % 10 as legal_entity_seq_id,
            'ST' || {_text('sk')} as ccl_bill_to_site,
            case when sk % 13 = 12 then 'CCA' else 'CCL' end as gl_identifier,
            {SELLER_SEGMENT} as balancing_segment,
            cast(case when sk % 2 = 0 then 0 else 20000 end as decimal(20,6)) as max_unit_price,
            case when sk % 2 = 0 then 'Y' else 'N' end as ccl_ar_ibs,
            case when sk % 5 = 0 then 'Y' else 'N' end as use_global_cust_site,
            case when sk % 11 = 10 then 'N' when sk % 7 = 6 then 'O' else 'Y' end
                as ccl_ar_interface_required
        from (select s_suppkey as sk from {{supplier}}) s
        union all
        select ck * 10 + 2, cast(null as bigint), 'BT' || {_text('ck')}, 'CCL', {BUYER_SEGMENT},
            cast(null as decimal(20,6)), 'N', 'N', 'N'
        from (select c_custkey as ck from {{customer}}) c""",
    "mgmt_entity_his": """
        select cast(n_nationkey as bigint) as mgmt_entity_his_id,
            case when n_nationkey % 6 = 0 then 'EXTERN' else 'ME-' || n_name end as mars_mgmt_entity
        from {nation}""",
    "legal_entity_his": f"""
        select distinct 1000 + s_suppkey % 10 as legal_entity_his_id,
            200 + s_suppkey % 10 as country_his_id,
            case when s_suppkey % 10 in (0, 4) then 'A01098' else 'LE' || {_text('s_suppkey % 10')} end
                as gold_id from {{supplier}}
        union all
        select cast(n_nationkey as bigint), cast(n_nationkey as bigint), 'BLE' || {_text('n_nationkey')}
        from {{nation}}""",
    "legal_entity": f"""
        select distinct 1000 + s_suppkey % 10 as legal_entity_seq_id,
            cast({_digit('s_suppkey')} + 1 as bigint) as country_id from {{supplier}}""",
    "country_his": f"""
        select distinct 200 + s_suppkey % 10 as country_his_id,
            cast({_digit('s_suppkey')} + 1 as bigint) as country_id,
            {_country('s_suppkey')} as country_code, 2 as decimals from {{supplier}}
        union all
        select cast(n_nationkey as bigint), cast(null as bigint), 'X' || {_text('n_nationkey')},
            cast(null as int) from {{nation}}""",
    "country": f"""
        select distinct cast({_digit('s_suppkey')} + 1 as bigint) as country_id,
            {_country('s_suppkey')} as country_code, {_country('s_suppkey')} || '3' as country_code_iso3,
            case when s_suppkey % 10 in (3, 7) then 'CTX-' || {_country('s_suppkey')} else null end
                as ccl_ar_header_dff_context,
            case when s_suppkey % 10 in (4, 9) then 'N' when s_suppkey % 10 = 7 then null else 'Y' end
                as is_vat_regime from {{supplier}}""",
    "pl_contact": """
        select s_suppkey * 10 + 1 as pl_seq_id, s_suppkey + 1 as user_seq_id,
            'GBS Contact' as contact_type, 1 as contact_order, 'Y' as is_active from {supplier}
        union all
        select s_suppkey * 10 + 1, s_suppkey + 2, 'GBS Contact', case when s_suppkey % 3 = 0 then 2 else 1 end,
            case when s_suppkey % 4 = 0 then 'N' else 'Y' end from {supplier}
        union all
        select s_suppkey * 10 + 1, s_suppkey + 3, 'Other', 1, 'Y' from {supplier}""",
    "app_user": f"""
        select c_custkey as user_seq_id,
            case when c_custkey % 9 = 0 then null else c_mktsegment end as first_name,
            case when c_custkey % 8 = 0 then null else c_name end as last_name,
            'W' || {_text('c_custkey')} as work_id from {{customer}}""",
    "buc": f"""
        select cast(n_nationkey as bigint) as buc_id, 'BUC' || {_text('n_nationkey')} as buc,
            case when n_nationkey % 4 = 0 then null else 'MLE' || {_text('n_nationkey')} end as mars_le
        from {{nation}}""",
    "je_line_type": f"""
        select distinct je_line_type_id, je_line_type_cat as je_category,
            je_line__type_sub_cat as sub_category, je_line_type_sub_sub_cat as sub_sub_category,
            je_line_tax_type as je_tax, je_line_type_interco as je_interco
        from (select {TYPE_COLUMNS} from (select p_partkey as pk from {{part}}) p) q""",
    "look_up": f"""
        select distinct 'OUTBOUND' as type, 'CCL_AR' as look_code, 'CHINESE_CHAR' as look_name,
            'FuWu' as value from {{region}}
        union all select distinct 'INTERFACES', 'cclar.out', 'runtype', 'prod' from {{region}}
        union all
        select distinct 'CCLAR-CHINA_EXCEPTION', {ACCOUNT}, '9' || {_padded('pk % 1200', 9)},
            case pk % 12 when 0 then 'CRE001' when 1 then 'CRE002' else 'JT' || {_text('pk % 12')} end
        from (select p_partkey as pk from {{part}} where p_partkey % 1200 % 7 = 0) p""",
    "contracts": f"""
        select {REFERENCE} as reference_id, 'CT' || {_text('ck')} as contract_number
        from (select c_custkey as ck from {{customer}}) c where ck % 7 <> 0 and ck % 6 <> 0""",
    "company_code": f"""
        select {SELLER_SEGMENT} as balancing_segment, 'C' || {_padded('sk % 1000', 3)} as company_code
        from (select s_suppkey as sk from {{supplier}}) s where sk % 3 <> 0 and sk % 5 <> 0
        union all
        select {BUYER_SEGMENT}, 'D' || {_padded('ck % 1000', 3)}
        from (select c_custkey as ck from {{customer}}) c where ck % 3 <> 0 and ck % 5 <> 0""",
    "customer_site": f"""
        select flag as use_global_cust_site, 'BT' || {_text('ck')} as bill_to_site,
            {REFERENCE} as reference_id, 'CS' || flag || {_text('ck')} as customer_site
        from (select c_custkey as ck, 'Y' as flag from {{customer}}
            union all select c_custkey, 'N' from {{customer}}) c where ck % 29 <> 0""",
    "vat_gst": """
        select rel as billing_rel_id, 'SELLER' as vat_gst_type,
            case sk % 3 when 0 then 'IGS' when 1 then 'CGS' else 'SGS' end as sabrix_tax_type
        from (select distinct rel, sk from {billed}) r
        union all select rel, 'BUYER', 'OTH' from (select distinct rel from {billed}) q""",
    "employees": """
        select c_name as first_name, cast(c_nationkey as bigint) as department_id,
            o_orderdate as hire_date from {orders} join {customer} on o_custkey = c_custkey""",
    "departments": """
        select cast(n_nationkey as bigint) as department_id, n_name as department_name from {nation}""",
}

HELPERS = ["billed", "entry", "settled", "invoice"]

# The same rows as `invoice` and `invoice_line` of SQL, in steps that move less. `billed` lies by order, and an
# invoice belongs to one order (its number ends in the country's digit), so its sums need no shuffle.
INVOICE = SQL["invoice"].replace("group by inv", "group by ok, inv")
# The lines of an order and supplier have one invoice and relation, so `settled` adds up lines of `entry` where they lie.
SETTLED = SQL["settled"].replace("{billed}", "{entry}").replace("min(inv) as inv", "inv").replace("min(rel) as rel", "rel")
SETTLED = SETTLED.replace("group by ok, sk", "group by inv, rel, ok, sk")
# What `entry` is moved without: these follow from the other columns, as in `billed`. Run and relation grow with the
# date and the customer, so their least values are those of the least date and customer.
ENTRY_MADE = {
    "run": "cast(year(od) * 10000 + month(od) * 100 + day(od) as bigint)", "inv": f"ok * 10 + {_digit('sk')}",
    "rel": "sk * 10000000 + ck",
}
ENTRY_COLUMNS = ["ok", "sk", "ln", "ck", "od", "run", "inv", "rel", "pk", "item", "vat", "rate"]
HEADERS, DETAILS = SQL["invoice_line"].split("union all", 1)
# One row per billed line meets its part; its two or three invoice lines are made where it then lies.
NAMED = """
    select inv, run, rel, pk, rate, item, vat, ck, coalesce(ln = 1 and pk % 50 = 0 and sk % 10 not in (1, 6), false) as fee,
        p_name, p_brand
    from {billed} join {part} on p_partkey = pk"""
KINDS = """(
    select *, explode(case when fee then array('ITEM', 'VAT', 'FEE') else array('ITEM', 'VAT') end) as kind from {named}) k"""
DETAILS = DETAILS[:DETAILS.rindex("from (")] + "from " + KINDS
DETAIL_COLUMNS = """ as d(invoice_prefix_seq_id, run_seq_id, brid_billing_rel_id, inv_line_type, rate_percentage,
    tax_comp_amt, ntax_comp_amt, service_desc, service_name_translated, in_sending_gl)"""
LINE_PLACE = ["invoice_prefix_seq_id", "brid_billing_rel_id"]


def needs_of(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"{(\w+)}", sql)))


def needs(name: str) -> list[str]:
    return needs_of(SQL[name])


_STORED: dict[tuple[str, str], "Adapter"] = {}


class Adapter(dict):
    """Billing tables of one driver folder, each built and stored when it is first asked for.

    Stored, because the billing tables are tables: queries then scan Parquet files, as they would
    in production, instead of deriving every table again for every join.
    """

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        elif hasattr(self, f"_{name}"):
            df = getattr(self, f"_{name}")()
        else:
            df = self._made(SQL[name])
            df = materialize(schemas.typed(df, name) if name in schemas.TABLES else df, name)
        if name in schemas.TABLES:
            df = schemas.normalize_empty(df)
        self[name] = df
        return df

    def _made(self, sql: str, **given: DataFrame) -> DataFrame:
        return self.spark.sql(sql, **{n: given[n] if n in given else self[n] for n in needs_of(sql)})

    def _billed_rows(self) -> DataFrame:
        lines = self["lineitem"].select(
            "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_discount", "l_tax"
        ).repartition(shuffle_partitions(self.spark), "l_orderkey")
        return self._made(SQL["billed"], lineitem=lines)

    def _billed(self) -> DataFrame:
        """Stored by order: the sums per order and supplier, line or invoice are then made where its lines lie."""
        return bucketed(self._billed_rows(), "billed", ["ok"], placed=True)

    def _entry(self) -> DataFrame:
        """Sorted by customer and part, which most texts of a journal line are made of: its files take less.

        `billed` is stored for the invoice tables; for `entry` alone it isn't written.
        """
        billed = self["billed"] if "billed" in self else self._billed_rows()
        rows = self._made(SQL["entry"], billed=billed).drop(*ENTRY_MADE)
        place = [F.expr(ENTRY_MADE[k]) for k in ("inv", "rel")]
        moved = rows.repartition(shuffle_partitions(self.spark), *place).sortWithinPartitions("ck", "pk")
        made = moved.withColumns({k: F.expr(e) for k, e in ENTRY_MADE.items()}).select(*ENTRY_COLUMNS)
        return bucketed(made, "entry", ["inv", "rel"], placed=True)

    def _settled(self) -> DataFrame:
        """Not stored: made from `entry` without a shuffle."""
        return self._made(SETTLED)

    def _invoice(self) -> DataFrame:
        """Not stored: made from `billed` without a shuffle."""
        return self._made(INVOICE)

    def _je_line(self) -> DataFrame:
        """Written where the narrow rows lie that its wide ones are made of."""
        settled = self["settled"].sortWithinPartitions("ck", "pk")
        rows = schemas.typed(self._made(SQL["je_line"], settled=settled), "je_line")
        return bucketed(rows, "je_line", ["invoice_prefix_seq_id", "billing_rel_id"], ["je_type"], placed=True)

    def _je_source(self) -> DataFrame:
        return bucketed(journal.source_lines({"je_line": self["je_line"]}), "je_source", ["je_line_seq_id"])

    def _invoice_line(self) -> DataFrame:
        """Lines of relations stored by invoice and relation; HEADER lines, which have no relation, are made of `invoice`."""
        named = self._made(NAMED).repartition(shuffle_partitions(self.spark), "inv", "rel")
        details = self._made(f"select * from ({DETAILS}){DETAIL_COLUMNS}", named=named)
        stored = bucketed(schemas.typed(details, "invoice_line"), "invoice_line", LINE_PLACE, placed=True)
        return schemas.typed(self._made(HEADERS), "invoice_line").unionByName(stored)


def billing_tables(spark: SparkSession, folder: str) -> Adapter:
    """The billing tables of a driver folder, shared by all queries of a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORED:
        _STORED[key] = Adapter(spark, folder)
    return _STORED[key]
