"""Billing relations with their route, seller, buyer and contact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from outledger.functions import rules

Tables = Mapping[str, DataFrame]

# Fixed values of the interface.
CONTACT_TYPE = "GBS Contact"
OTHER_SETTLEMENT = "OTH"


def as_role(df: DataFrame, role: str) -> DataFrame:
    """Prefix every column, so that one table can be joined in several roles."""
    return df.select(*[F.col(c).alias(f"{role}_{c}") for c in df.columns])


def primary_contact(contacts: DataFrame, users: DataFrame) -> DataFrame:
    """Per seller: the highest active first contact, as `first last (id)`."""
    chosen = (
        contacts.filter(
            (F.col("contact_type") == CONTACT_TYPE)
            & (F.col("contact_order") == 1)
            & (F.col("is_active") == "Y")
        )
        .groupBy("pl_seq_id")
        .agg(F.max("user_seq_id").alias("user_seq_id"))
    )
    name = rules.contact_name(F.col("first_name"), F.col("last_name"), F.col("work_id"))
    return chosen.join(users, "user_seq_id", "left").select(
        "pl_seq_id", "user_seq_id", name.alias("plcontact")
    )


def parties(t: Tables) -> DataFrame:
    """One row per historic profit-and-loss unit, with its unit, entity and legal entity."""
    return (
        t["pl_his"]
        .join(t["pl"], "pl_seq_id")
        .join(t["mgmt_entity_his"], "mgmt_entity_his_id")
        .join(t["legal_entity_his"], "legal_entity_his_id")
    )


def sellers(t: Tables) -> DataFrame:
    """Parties that can sell: their country keeps decimals; contact and VAT regime added."""
    country_his = (
        t["country_his"]
        .filter(F.col("decimals").isNotNull())
        .select("country_his_id", "country_id", "country_code")
    )
    country = t["country"].drop("country_code")
    contact = primary_contact(t["pl_contact"], t["app_user"]).drop("user_seq_id")
    return (
        parties(t)
        .join(country_his, "country_his_id")
        .join(country, "country_id")
        .join(contact, "pl_seq_id", "left")
        .withColumn("is_vat_regime", F.coalesce("is_vat_regime", F.lit("Y")))
    )


def counterparties(t: Tables) -> DataFrame:
    """One row per billing relation whose seller takes part in the interface.

    The organization tables are joined to each other first, so the large relation table meets five
    prepared sides only. No side is forced to broadcast: their sizes decide at run time.
    """
    route = t["billing_route"].select(
        "billing_route_id", "route_type", "route_id", "route_version",
        F.col("buc").alias("route_buc"), "adn",
    )
    seller, buyer = as_role(sellers(t), "s"), as_role(parties(t), "b")
    seller_buc, buyer_buc = as_role(t["buc"], "sb"), as_role(t["buc"], "bb")
    c = F.col
    flag = c("s_ccl_ar_interface_required")
    takes_part = (flag == "Y") | ((flag == "O") & (c("settlement_type") == OTHER_SETTLEMENT))
    return (
        t["billing_rel"]
        .join(buyer, c("buyer_pl_seq_id") == c("b_pl_his_id"))
        .join(route, "billing_route_id")
        .join(seller, c("seller_pl_seq_id") == c("s_pl_his_id"))
        .filter(takes_part)
        .join(seller_buc, c("seller_buc_id") == c("sb_buc_id"))
        .join(buyer_buc, c("buyer_buc_id") == c("bb_buc_id"), "left")
        .select(
            "route_type",
            "route_id",
            "route_version",
            "billing_rel_id",
            c("relationship_ind").alias("bill_rel_key"),
            F.coalesce("consumption_per", F.lit(1).cast("decimal(12,6)")).alias("consumption_per"),
            c("s_plcontact").alias("plcontact"),
            c("sb_buc").alias("s_buc"),
            c("b_mars_mgmt_entity").alias("b_me"),
            c("s_mars_mgmt_entity").alias("s_me"),
            c("bb_buc").alias("b_buc"),
            c("bb_mars_le").alias("b_buc_mars_le"),
            c("b_gold_id").alias("b_le"),
            c("s_gold_id").alias("s_le"),
            c("s_ccl_bill_to_site").alias("ccl_bill_to_site"),
            c("b_ccl_bill_to_site").alias("buyer_ccl_bill_to_site"),
            c("s_gl_identifier").alias("s_gl"),
            c("b_gl_identifier").alias("b_gl"),
            rules.segment_for_role(c("buyer_role"), c("b_balancing_segment")).alias("b_bal_seg"),
            rules.segment_for_role(c("seller_role"), c("s_balancing_segment")).alias("s_bal_seg"),
            c("s_max_unit_price").alias("max_unit_price"),
            c("s_country_code").alias("country_code"),
            c("s_country_code_iso3").alias("country_code_iso3166"),
            c("s_ccl_ar_header_dff_context").alias("header_context"),
            c("b_pl_seq_id").alias("buyer_pl"),
            c("s_pl_seq_id").alias("seller_pl"),
            c("route_buc").alias("buc"),
            "adn",
            c("s_ccl_ar_ibs").alias("ccl_ar_ibs"),
            c("s_use_global_cust_site").alias("use_global_cust_site"),
            flag.alias("ccl_ar_interface_required"),
            "settlement_type",
            c("s_is_vat_regime").alias("seller_vat_regime"),
        )
    )
