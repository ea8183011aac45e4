"""The declared data-quality rules of every table, and the business rule of the fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.operators.quality import SUMMARY_COLUMNS, Rule, check

# Columns that may not be NULL.
NOT_NULL = {
    "stg_cnaes": "cnae_code cnae_description",
    "stg_simples": "company_root_cnpj",
    "stg_companies": "company_root_cnpj legal_name legal_nature_code share_capital",
    "stg_establishments": "full_cnpj company_root_cnpj branch_order check_digits primary_cnae_code",
    "stg_partners": "company_root_cnpj partner_identifier_code partner_qualification_code",
    "company_profile": "company_root_cnpj",
    "establishment_activity": "full_cnpj company_root_cnpj primary_cnae_code",
    "partner_metrics": "company_root_cnpj partner_count",
    "active_company_base": "full_cnpj company_root_cnpj primary_cnae_code partner_count",
    "dim_cnaes": "cnae_code cnae_description cnae_division_code cnae_group_code cnae_class_code "
    "cnae_subclass_code",
    "dim_companies": "company_root_cnpj legal_name legal_nature_code share_capital is_simples is_mei",
    "dim_establishments": "full_cnpj company_root_cnpj branch_order is_headquarters is_branch "
    "is_active primary_cnae_code primary_cnae_description has_phone has_email",
    "fct_active_companies": "company_root_cnpj representative_full_cnpj primary_cnae_code "
    "is_simples is_mei active_company_count active_establishment_count "
    "active_headquarters_count active_branch_count share_capital_amount partner_count "
    "legal_entity_partner_count individual_partner_count foreign_partner_count",
    "share_capital_snapshot": "company_root_cnpj share_capital dbt_scd_id dbt_valid_from",
}

# Columns whose values may not repeat.
UNIQUE = {
    "stg_cnaes": "cnae_code",
    "stg_companies": "company_root_cnpj",
    "stg_establishments": "full_cnpj",
    "company_profile": "company_root_cnpj",
    "establishment_activity": "full_cnpj",
    "partner_metrics": "company_root_cnpj",
    "active_company_base": "full_cnpj",
    "dim_cnaes": "cnae_code",
    "dim_companies": "company_root_cnpj",
    "dim_establishments": "full_cnpj",
    "fct_active_companies": "company_root_cnpj",
    "share_capital_snapshot": "dbt_scd_id",
}

# The code lists.
OPTIONS = ("S", "N")
SIZES = ("00", "01", "03", "05")
BRANCH_TYPES = ("1", "2")
STATUSES = ("01", "02", "03", "04", "08")
PARTNER_KINDS = ("1", "2", "3")
CAPITAL_RANGES = ("up_to_10k", "10k_to_100k", "100k_to_1m", "over_1m")
SIZE_LABELS = ("not_informed", "micro_company", "small_company", "other", "unknown")
BRANCH_LABELS = ("headquarters", "branch", "unknown")
STATUS_LABELS = ("null", "active", "suspended", "unsuitable", "closed", "unknown")

# Columns that hold only listed values, or NULL.
ACCEPTED_VALUES = {
    ("stg_simples", "simples_option"): OPTIONS,
    ("stg_simples", "mei_option"): OPTIONS,
    ("stg_companies", "company_size_code"): SIZES,
    ("stg_establishments", "branch_type_code"): BRANCH_TYPES,
    ("stg_establishments", "registration_status_code"): STATUSES,
    ("stg_partners", "partner_identifier_code"): PARTNER_KINDS,
    ("dim_companies", "share_capital_range"): CAPITAL_RANGES,
    ("dim_companies", "company_size_code"): SIZES,
    ("dim_companies", "company_size_label"): SIZE_LABELS,
    ("dim_establishments", "branch_type_code"): BRANCH_TYPES,
    ("dim_establishments", "branch_type_label"): BRANCH_LABELS,
    ("dim_establishments", "registration_status_code"): STATUSES,
    ("dim_establishments", "registration_status_label"): STATUS_LABELS,
    ("fct_active_companies", "representative_branch_type_code"): BRANCH_TYPES,
    ("fct_active_companies", "company_size_code"): SIZES,
    ("fct_active_companies", "active_company_count"): (1,),
}

# Child column and the parent column that must hold each of its values.
RELATIONSHIPS = {
    ("establishment_activity", "primary_cnae_code"): ("stg_cnaes", "cnae_code"),
    ("active_company_base", "primary_cnae_code"): ("stg_cnaes", "cnae_code"),
    ("dim_establishments", "primary_cnae_code"): ("dim_cnaes", "cnae_code"),
    ("fct_active_companies", "representative_full_cnpj"): ("dim_establishments", "full_cnpj"),
    ("fct_active_companies", "primary_cnae_code"): ("dim_cnaes", "cnae_code"),
}

RULES = (
    *(Rule(t, c, "not_null") for t, names in NOT_NULL.items() for c in names.split()),
    *(Rule(t, c, "unique") for t, c in UNIQUE.items()),
    *(Rule(t, c, "accepted_values", values=v) for (t, c), v in ACCEPTED_VALUES.items()),
    *(Rule(t, c, "relationships", parent=p) for (t, c), p in RELATIONSHIPS.items()),
)

BUSINESS_RULE = "active_company_metrics_are_consistent"


def inconsistent_active_companies(fact: DataFrame) -> DataFrame:
    """Fact rows whose measures contradict each other; a NULL contradicts nothing."""
    companies, all_, headquarters, branches = (
        F.col(f"active_{what}_count") for what in ("company", "establishment", "headquarters", "branch")
    )
    kinds = ("legal_entity", "individual", "foreign")
    partners = [F.col(f"{kind}_partner_count") for kind in kinds]
    contradictions = (
        (companies != 1)
        | (all_ < 1)
        | (all_ != headquarters + branches)
        | (headquarters > all_)
        | (branches > all_)
        | (F.col("share_capital_amount") < 0)
        | (F.col("partner_count") != partners[0] + partners[1] + partners[2])
    )
    return fact.select(
        "company_root_cnpj", "active_company_count", "active_establishment_count",
        "active_headquarters_count", "active_branch_count", "share_capital_amount",
        "partner_count", *(f"{kind}_partner_count" for kind in kinds),
    ).filter(contradictions)


def run_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared rule, and one for the business rule."""
    business = inconsistent_active_companies(tables["fct_active_companies"]).agg(
        F.count(F.lit(1)).alias("failures")
    )
    return check(tables, RULES).unionByName(
        business.select(
            F.lit("fct_active_companies").alias("table_name"),
            F.lit("*").alias("column_name"),
            F.lit(BUSINESS_RULE).alias("test_name"),
            "failures",
        ).select(*SUMMARY_COLUMNS)
    )
