"""Raw table schemas and table names."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

DOMAIN = "company_registry"
ROOT = "company_root_cnpj"
FULL = "full_cnpj"
ACTIVITY_CODE = "cnae_code"

# The columns of each raw source, in file order. All of them are text.
RAW_COLUMNS = {
    "cnaes": ("cnae_code", "cnae_description"),
    "simples": (
        "company_root_cnpj", "simples_option", "simples_option_date", "simples_exclusion_date",
        "mei_option", "mei_option_date", "mei_exclusion_date",
    ),
    "companies": (
        "company_root_cnpj", "legal_name", "legal_nature_code", "responsible_qualification_code",
        "share_capital", "company_size_code", "responsible_federative_entity",
    ),
    "establishments": (
        "company_root_cnpj", "branch_order", "check_digits", "branch_type_code", "trade_name",
        "registration_status_code", "registration_status_date", "registration_status_reason_code",
        "foreign_city_name", "country_code", "activity_start_date", "primary_cnae_code",
        "secondary_cnae_codes", "street_type", "street_name", "address_number",
        "address_complement", "district", "postal_code", "state", "municipality_code",
        "area_code_1", "phone_1", "area_code_2", "phone_2", "fax_area_code", "fax_number",
        "email", "special_status", "special_status_date",
    ),
    "partners": (
        "company_root_cnpj", "partner_identifier_code", "partner_name", "partner_document",
        "partner_qualification_code", "partnership_start_date", "country_code",
        "legal_representative_document", "legal_representative_name",
        "legal_representative_qualification_code", "partner_age_range_code",
    ),
}

# What the run writes beside the source columns.
METADATA_COLUMNS = {
    "loaded_at": "_loaded_at",
    "source_reference_date": "_source_reference_date",
    "pipeline_run_id": "_pipeline_run_id",
}


def text_schema(columns) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])


def raw_schema(source: str) -> StructType:
    return text_schema(RAW_COLUMNS[source])


def raw_table(source: str) -> str:
    return f"raw_{DOMAIN}_{source}"


def staging_table(source: str) -> str:
    return f"stg_{DOMAIN}__{source}"


def intermediate_table(model: str) -> str:
    return f"int_{DOMAIN}__{model}"


def snapshot_table(subject: str) -> str:
    return f"snap_{DOMAIN}__{subject}"
