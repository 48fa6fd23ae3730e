"""A small hand-made billing world: one seller per country, one buyer."""

from datetime import datetime
from decimal import Decimal as D

RUN, DAY = 7, datetime(2020, 5, 4)
COUNTRIES = {"US": 1, "IN": 2, "CN": 3, "CO": 4, "MX": 5, "RU": 6, "AR": 7}
BUYER = 900


def world(rows, charges, regime=None, cap="0", je=None, seller=None, extra=None):
    """Tables for `charges`: (country, invoice, relation, rate, item, vat) tuples.

    A relation id is its country's number times 100 plus a small number.
    """
    je, seller, extra = je or {}, seller or {}, extra or {}
    regime = regime or {}
    used = sorted({c[0] for c in charges})
    relations = sorted({(c[0], c[2]) for c in charges})
    pairs = sorted({(c[0], c[1], c[2]) for c in charges})
    invoices = sorted({(c[1], c[0]) for c in charges})
    first_country = {inv: country for inv, country in reversed(invoices)}
    lines, heads = [], {}
    for country, inv, rel, rate, item, vat in charges:
        rate = None if rate is None else D(rate)
        base = dict(
            run_seq_id=RUN, invoice_prefix_seq_id=inv, brid_billing_rel_id=rel,
            rate_percentage=rate, service_desc="Work, done", in_sending_gl="CCX",
        )
        lines.append(base | dict(inv_line_type="ITEM", tax_comp_amt=D(0), ntax_comp_amt=D(item)))
        lines.append(base | dict(inv_line_type="VAT", tax_comp_amt=D(vat), ntax_comp_amt=D(0)))
        heads[inv] = heads.get(inv, D(0)) + D(item) + D(vat)
    for inv, total in heads.items():
        lines.append(dict(
            run_seq_id=RUN, invoice_prefix_seq_id=inv, inv_line_type="HEADER",
            tax_comp_amt=D(0), ntax_comp_amt=total,
        ))
    journal = []
    for n, (country, inv, rel) in enumerate(pairs):
        base = dict(
            run_seq_id=RUN, invoice_prefix_seq_id=inv, billing_rel_id=rel, in_sending_gl="CCX",
            brin_op_gl="CCL", brin_balancing_segment="BAL1", brin_reference_id="REF1",
            brin_cost_center="CC1", project=" PRJ ", outbound_id="Buyer", billing_curr="USD",
            gl_account="ACC1", je_line_type_id="JT1", je_line_type_cat="AR",
            je_line__type_sub_cat="OTH", je_line_type_sub_sub_cat="SS", je_line_tax_type="TX",
            je_line_type_interco="OOB", vat_percentage=D("0.05"),
            in_je_description="a|b|c|d|mail|  f|g", created_on=DAY, shadow_ind=None,
        )
        journal.append(base | dict(
            je_line_seq_id=10 * n + 1, je_type="REC", src_je_line_seq_id=10 * n + 2,
            billing_amt=D(1)) | je)
        journal.append(base | dict(
            je_line_seq_id=10 * n + 2, je_type="INC", gl_account="ORIG", billing_amt=D(1)))
        journal.append(base | dict(je_line_seq_id=10 * n + 3, je_type="AR", billing_amt=D("12.345")) | je)
        journal.append(base | dict(
            je_line_seq_id=10 * n + 4, je_type="VAT", gl_account="VATACC",
            je_line__type_sub_cat="igs", billing_amt=D(1)))
    pls = [
        dict(
            pl_seq_id=n, legal_entity_seq_id=n, gl_identifier="CCL", balancing_segment="SEG4",
            max_unit_price=D(cap), ccl_ar_ibs="Y", use_global_cust_site="N",
            ccl_ar_interface_required="Y",
        ) | seller
        for n in (COUNTRIES[c] for c in used)
    ]
    pls.append(dict(
        pl_seq_id=BUYER, gl_identifier="CCL", balancing_segment="BUYERSEG", ccl_bill_to_site="BT",
        ccl_ar_interface_required="N",
    ))
    n_of = [COUNTRIES[c] for c in used]
    tables = {
        "je_line": journal,
        "invoice_line": lines,
        "run": [dict(run_seq_id=RUN, run_date=DAY)],
        "invoice_prefix": [
            dict(
                invoice_prefix_seq_id=inv, nickname="N", invoice_type="I", lst_invoice_nbr=str(inv),
                pl_seq_id=COUNTRIES[c],
            )
            for inv, c in first_country.items()
        ],
        "invoice_header": [
            dict(
                invoice_prefix_seq_id=inv, billing_ref="BR", settlement_type="NON-IBS",
                bic="B,C", iban="IB",
            )
            for inv in first_country
        ],
        "gl_account": [
            dict(acct_number="ACC1", tp_required="Y", is_active="Y"),
            dict(acct_number="ACC1", tp_required="N", is_active="N"),
        ],
        "cost_center": [
            dict(cost_center="CC1", product_line="PL2"), dict(cost_center="CC1", product_line=None),
            dict(cost_center="CC1", product_line="PL1"),
        ],
        "service": [],
        "billing_route": [
            dict(billing_route_id=1, route_type="POP", route_id="R1", route_version="3", adn="ADN1")
        ],
        "billing_rel": [
            dict(
                billing_rel_id=rel, billing_route_id=1, relationship_ind="K", seller_role="S",
                buyer_role="B", settlement_type="IBS", seller_pl_seq_id=COUNTRIES[c],
                buyer_pl_seq_id=BUYER, seller_buc_id=1, buyer_buc_id=2,
            )
            for c, rel in relations
        ],
        "pl_his": [
            dict(pl_his_id=n, pl_seq_id=n, mgmt_entity_his_id=1, legal_entity_his_id=n)
            for n in n_of + [BUYER]
        ],
        "pl": pls,
        "mgmt_entity_his": [dict(mgmt_entity_his_id=1, mars_mgmt_entity="ME")],
        "legal_entity_his": [
            dict(legal_entity_his_id=n, country_his_id=n, gold_id="LE") for n in n_of + [BUYER]
        ],
        "legal_entity": [dict(legal_entity_seq_id=n, country_id=n) for n in n_of],
        "country_his": [
            dict(country_his_id=COUNTRIES[c], country_id=COUNTRIES[c], country_code=c, decimals=2)
            for c in used
        ],
        "country": [
            dict(
                country_id=COUNTRIES[c], country_code=c, country_code_iso3=c + "X",
                is_vat_regime=regime.get(c, "Y"),
            )
            for c in used
        ],
        "pl_contact": [],
        "app_user": [],
        "buc": [dict(buc_id=1, buc="SBUC"), dict(buc_id=2, buc="BBUC", mars_le="MLE")],
        "look_up": [
            dict(type="OUTBOUND", look_code="CCL_AR", look_name="CHINESE_CHAR", value="FW"),
            dict(type="INTERFACES", look_code="cclar.out", look_name="runtype", value="prod"),
        ],
        "je_line_type": [],
        "outbound_summary": [dict(run_seq_id=RUN, gl_identifier="CCA", run_on=DAY)],
        "contracts": [dict(reference_id="REF1", contract_number="CT1")],
        "company_code": [dict(balancing_segment="BUYERSEG", company_code="C001")],
        "customer_site": [
            dict(
                use_global_cust_site="N", bill_to_site="BT", reference_id="REF1",
                customer_site="SITE",
            )
        ],
        "vat_gst": [],
    }
    for name, more in extra.items():
        tables[name] = tables[name] + more
    return {name: rows(name, *records) for name, records in tables.items()}
