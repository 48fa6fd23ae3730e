"""Column rules of the billing interface: texts, entities, accounts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from outledger.functions.text import (
    blank, dashes_for_commas, iso_day_text, joined, packed_field, short_percent_text,
    without_commas,
)

# Fixed values of the interface.
SENDERS_WITHOUT_REFERENCE = ["AHB", "ARS", "SVB", "ESB", "SRS", "ERS"]
DETAIL_SENDER = "AHB"
STANDARD_BILLING_SENDER = "ESB"
NO_SEGMENT = " "
NO_PARTNER = "0000"
VAT_ACCOUNT = "2076001001"
MEXICO_VAT_ACCOUNT = "2076001008"
MEXICO_ZERO_RATE_ACCOUNTS = {
    "OOB": "4020601650",
    "WOB": "4020613650",
    "GEC": "4020201650",
    "EXT": "4020101650",
}
INDIA_TAX_TYPES = {"IGS": "IGST", "CGS": "CGST", "SGS": "SGST"}


def seg_entity(segment: Column) -> Column:
    return F.substring(segment, 1, 6)


def seg_legal_entity(segment: Column) -> Column:
    return F.substring(segment, 7, 6)


def masked_reference(sender: Column, reference: Column) -> Column:
    """Some senders' references are not shown; an unknown sender's is."""
    return F.when(sender.isin(SENDERS_WITHOUT_REFERENCE), F.lit(None)).otherwise(reference)


def invoice_number(nickname: Column, invoice_type: Column, last_number: Column) -> Column:
    return joined(nickname, invoice_type, "-", last_number)


def relation_key(route_type: Column, route_id: Column, version: Column, key: Column) -> Column:
    return joined(route_type, "-", route_id, "-", F.lpad(version, 2, "0"), "-", key)


def contact_name(first: Column, last: Column, work_id: Column) -> Column:
    return F.when(first.isNotNull(), joined(first, " ", last, " (", work_id, ")"))


def contact_text(
    sender: Column, description: Column, route_type: Column, pop_site: str, other_site: str
) -> Column:
    return (
        F.when(sender == DETAIL_SENDER, packed_field(description, 5))
        .when(route_type == "POP", F.lit(pop_site))
        .otherwise(F.lit(other_site))
    )


def header_text(
    settlement: Column, from_buc: Column, to_buc: Column, bic: Column, iban: Column
) -> Column:
    return (
        F.when(settlement == "IBS", joined("IBS  ", from_buc, " ", to_buc))
        .when(
            settlement == "NON-IBS",
            joined(
                "Due upon receipt.  Please send payment directly to our bank. ", bic, " ", iban
            ),
        )
        .otherwise(F.lit("NON IBS, ACA"))
    )


def segment_for_role(role: Column, segment: Column) -> Column:
    return F.when(role.isNull(), F.lit(NO_SEGMENT)).otherwise(segment)


def intercompany_entity(
    cat: Column, sub: Column, type_id: Column, buyer_entity: Column, seller_entity: Column,
    buyer_segment: Column, seller_segment: Column, source_segment: Column,
) -> Column:
    """Inter-company management entity; the first matching rule wins, else NULL."""
    ar, ap, aca = cat == "AR", cat == "AP", sub == "ACA"
    outside = (sub != "IBS") & (buyer_entity != "EXTERN")
    return (
        F.when(ar & (sub == "DR4"), seg_entity(buyer_segment))
        .when(ar & aca & (type_id == "CRE001"), F.lit("GBUS01"))
        .when(ar & aca, seg_entity(buyer_segment))
        .when(cat.isin("AR", "BEX") & (sub == "ESB"), buyer_entity)
        .when(ar & outside, buyer_entity)
        .when(ap & (sub == "DR4"), seller_entity)
        .when(ap & aca & (type_id == "CRE002"), seg_entity(source_segment))
        .when(ap & aca, seg_entity(seller_segment))
        .when(ap & outside, seg_entity(seller_segment))
    )


def intercompany_legal_entity(
    cat: Column, sub: Column, type_id: Column, seller_le: Column, buyer_le: Column,
    buyer_buc_le: Column, buyer_segment: Column, seller_segment: Column, source_segment: Column,
) -> Column:
    """Inter-company legal entity; the first matching rule wins, else NULL."""
    ar, ap, aca = cat == "AR", cat == "AP", sub == "ACA"
    return (
        F.when(ar & (sub == "DR4"), seg_legal_entity(buyer_segment))
        .when(
            ar & aca & (type_id == "CRE001"),
            F.when(seller_le == "A01098", F.lit("M45000")).otherwise(F.lit("E29000")),
        )
        .when(ar & aca, seg_legal_entity(buyer_segment))
        .when(cat.isin("AR", "BEX") & (sub == "ESB"), F.coalesce(buyer_buc_le, buyer_le))
        .when(ap & aca & (type_id == "CRE002"), seg_legal_entity(source_segment))
        .when(ap & aca, seg_legal_entity(seller_segment))
    )


def document_type(invoice_amount: Column) -> Column:
    return F.when(invoice_amount < 0, F.lit("CM")).otherwise(F.lit("INV"))


def lockbox(country: Column) -> Column:
    return F.when(country == "AR", F.lit("ARBANK_DAILY")).otherwise(F.lit("MOR"))


def only_ibs(flag: Column, value: Column) -> Column:
    return F.when(flag == "Y", value)


def mexico_account(interco: Column, account: Column) -> Column:
    chosen = account
    for code, replacement in MEXICO_ZERO_RATE_ACCOUNTS.items():
        chosen = F.when(interco == code, F.lit(replacement)).otherwise(chosen)
    return chosen


def account_override(country: Column, rate: Column, interco: Column, account: Column) -> Column:
    """Mexican charges without tax are booked by inter-company code."""
    untaxed = F.coalesce(rate, F.lit(0).cast("decimal(12,6)")) == 0
    return F.when((country == "MX") & untaxed, mexico_account(interco, account)).otherwise(account)


def vat_account(country: Column, account_vat: Column) -> Column:
    return F.when(country == "MX", F.lit(MEXICO_VAT_ACCOUNT)).otherwise(
        F.coalesce(account_vat, F.lit(VAT_ACCOUNT))
    )


def india_tax_type(sub_category: Column) -> Column:
    """NULL for any other tax type."""
    chosen = F.lit(None).cast("string")
    for code, printed in INDIA_TAX_TYPES.items():
        chosen = F.when(F.upper(sub_category) == code, F.lit(printed)).otherwise(chosen)
    return chosen


def needs_partner(flag: Column) -> Column:
    return F.upper(flag).isin("Y", "T")


def partner_segment(direction: Column, seller_segment: Column, buyer_segment: Column) -> Column:
    """The other side's segment: the seller's for a buyer line and the buyer's for a seller line."""
    return F.when(F.upper(direction) == "BUYER", seller_segment).when(
        F.upper(direction) == "SELLER", buyer_segment
    )


def trading_partner(required: Column, segment: Column, mapped_company: Column) -> Column:
    company = F.when(F.length(segment) == 4, segment).otherwise(mapped_company)
    return F.coalesce(F.when(required, company), F.lit(NO_PARTNER))


def described(reference: Column, text: Column) -> Column:
    """`<reference> - <text>`, or the text alone when there is no reference."""
    prefix = F.when(reference.isNotNull(), joined(reference, " - "))
    return dashes_for_commas(joined(prefix, text))


def service_charge(local_word: Column) -> Column:
    return joined(local_word, " Service charge")


def rec_description(
    country: Column, sender: Column, reference: Column, text: Column, local_word: Column
) -> Column:
    china = service_charge(local_word)
    various = dashes_for_commas(
        F.when(country == "CN", joined("Various ", china)).otherwise(
            F.lit("Various - Enterprise Standard Billing")
        )
    )
    plain = described(reference, F.when(country == "CN", china).otherwise(text))
    return F.when(sender == STANDARD_BILLING_SENDER, various).otherwise(plain)


def descriptor(row, short: Column) -> Column:
    """Pipe-joined journal text, cut to 150 characters before its commas are removed.

    `row` maps a column name to a Column. It has 10 parts for the short form, 18 for the detail
    sender and 15 otherwise; a NULL part stays empty between its pipes.
    """
    first = [
        iso_day_text(row("biller_run_date")), row("invoice_number"), row("bill_rel_key"),
        row("s_buc"), row("b_buc"), row("je_line_type_cat"), row("expense_category"),
        row("je_line_type_sub_sub_cat"), row("je_line_tax_type"), row("je_line_type_interco"),
    ]
    rates = [short_percent_text(row("tp_percentage")), short_percent_text(row("vat_percentage"))]
    packed = row("bex_je_description")
    detail = [packed_field(packed, n) for n in range(2, 6)]
    detail += [F.ltrim(packed_field(packed, n)) for n in (6, 7)]
    origin = [row("seller_cost_center"), row("orig_gl_account"), packed]

    def packed_text(parts: list[Column]) -> Column:
        return F.concat_ws("|", *[blank(p) for p in parts])

    text = (
        F.when(short, packed_text(first))
        .when(row("in_sending_gl") == DETAIL_SENDER, packed_text(first + rates + detail))
        .otherwise(packed_text(first + rates + origin))
    )
    return without_commas(F.substring(text, 1, 150))
