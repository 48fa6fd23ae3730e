"""Input schemas (Spark DDL) and the empty-text rule applied when a table is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

MONEY = "decimal(20,6)"
RATE = "decimal(12,6)"

TABLES: dict[str, str] = {
    "je_line": f"""
        run_seq_id long, invoice_prefix_seq_id long, je_line_seq_id long, src_je_line_seq_id long,
        billing_rel_id long, je_type string, in_sending_gl string, brin_op_gl string,
        brin_balancing_segment string, brin_reference_id string, brin_cost_center string,
        project string, outbound_id string, billing_curr string, billing_amt {MONEY},
        run_rec_number long, gl_account string, je_line_type_id string, je_line_type_cat string,
        je_line__type_sub_cat string, je_line_type_sub_sub_cat string, je_line_tax_type string,
        je_line_type_interco string, vat_percentage {RATE}, tp_percentage {RATE}, tp_type string,
        is_taxable string, in_je_description string, service_code string, shadow_ind string,
        created_on timestamp""",
    "run": "run_seq_id long, run_date timestamp",
    "invoice_prefix": """invoice_prefix_seq_id long, nickname string, invoice_type string,
        lst_invoice_nbr string, pl_seq_id long""",
    "invoice_header": """invoice_prefix_seq_id long, billing_ref string, settlement_type string,
        from_buc string, to_buc string, bic string, iban string""",
    "invoice_line": f"""invoice_prefix_seq_id long, run_seq_id long, brid_billing_rel_id long,
        inv_line_type string, rate_percentage {RATE}, tax_comp_amt {MONEY}, ntax_comp_amt {MONEY},
        service_desc string, service_name_translated string, in_sending_gl string""",
    "gl_account": "acct_number string, tp_required string, is_active string",
    "cost_center": "cost_center string, product_line string",
    "service": "code string, sbx_commodity_code string, is_active_ind string",
    "billing_route": """billing_route_id long, route_type string, route_id string,
        route_version string, buc string, adn string""",
    "billing_rel": f"""billing_rel_id long, billing_route_id long, relationship_ind string,
        consumption_per {RATE}, seller_role string, buyer_role string, settlement_type string,
        seller_pl_seq_id long, buyer_pl_seq_id long, seller_buc_id long, buyer_buc_id long""",
    "pl_his": "pl_his_id long, pl_seq_id long, mgmt_entity_his_id long, legal_entity_his_id long",
    "pl": f"""pl_seq_id long, legal_entity_seq_id long, ccl_bill_to_site string,
        gl_identifier string, balancing_segment string, max_unit_price {MONEY}, ccl_ar_ibs string,
        use_global_cust_site string, ccl_ar_interface_required string""",
    "mgmt_entity_his": "mgmt_entity_his_id long, mars_mgmt_entity string",
    "legal_entity_his": "legal_entity_his_id long, country_his_id long, gold_id string",
    "legal_entity": "legal_entity_seq_id long, country_id long",
    "country_his": "country_his_id long, country_id long, country_code string, decimals int",
    "country": """country_id long, country_code string, country_code_iso3 string,
        ccl_ar_header_dff_context string, is_vat_regime string""",
    "pl_contact": """pl_seq_id long, user_seq_id long, contact_type string, contact_order int,
        is_active string""",
    "app_user": "user_seq_id long, first_name string, last_name string, work_id string",
    "buc": "buc_id long, buc string, mars_le string",
    "look_up": "type string, look_code string, look_name string, value string",
    "je_line_type": """je_line_type_id string, je_category string, sub_category string,
        sub_sub_category string, je_tax string, je_interco string""",
    "outbound_summary": "run_seq_id long, gl_identifier string, run_on timestamp",
    "contracts": "reference_id string, contract_number string",
    "vat_gst": "billing_rel_id long, vat_gst_type string, sabrix_tax_type string",
    "company_code": "balancing_segment string, company_code string",
    "customer_site": """use_global_cust_site string, bill_to_site string, reference_id string,
        customer_site string""",
    "customers": "id int not null, name varchar(20) not null, age int not null",
    "users": "p_id int, firstname string, lastname string, secret string",
    "employees": "first_name string, department_id long, hire_date timestamp",
    "departments": "department_id long, department_name string",
}

# Codes that are only tested by equality, by length or against a non-empty literal. They keep
# their bare column so that filters on them still reach the Parquet scan.
CODES = {
    "je_type", "brin_op_gl", "inv_line_type", "is_active", "is_active_ind", "contact_type",
    "type", "look_code", "gl_identifier", "shadow_ind",
}


def struct(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def normalize_empty(df: DataFrame) -> DataFrame:
    """Empty text is NULL, as everywhere in the billing rules; codes stay as they are."""
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in CODES
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def typed(df: DataFrame, table: str) -> DataFrame:
    """Project a table to its declared columns and types; a missing column is an error."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in struct(table).fields]
    )


def conform(df: DataFrame, table: str) -> DataFrame:
    return normalize_empty(typed(df, table))
