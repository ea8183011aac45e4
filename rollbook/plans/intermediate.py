"""Intermediate models: company profile, establishment activity, partner metrics, active base.

Every roll-up aggregates before it shuffles, so a company with a great many rows arrives at its
reducer as one partial row per map task. The joins are left joins to one row per company; a hot
company on the left is split by adaptive execution (see ``session.SETTINGS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.labels import ACTIVE, BRANCH, HEADQUARTERS, equals_flag, zero_if_null
from rollbook.functions.standardize import yes_no_to_boolean
from rollbook.plans.schemas import FULL, RAW_COLUMNS, ROOT

PARTNER_KINDS = {"legal_entity": "1", "individual": "2", "foreign": "3"}
PARTNER_COUNTS = ("partner_count", *(f"{kind}_partner_count" for kind in PARTNER_KINDS))
PARTNER_DATES = ("first_partnership_start_date", "latest_partnership_start_date")


def simples_by_company(simples: DataFrame) -> DataFrame:
    """One row per company: latest option flags, first option dates, last exclusion dates."""
    return simples.groupBy(ROOT).agg(
        *(F.max(c).alias(c) for c in ("simples_option", "mei_option")),
        *(F.min(c).alias(c) for c in ("simples_option_date", "mei_option_date")),
        *(F.max(c).alias(c) for c in ("simples_exclusion_date", "mei_exclusion_date")),
    )


def company_profile(companies: DataFrame, simples: DataFrame) -> DataFrame:
    """Company attributes with the tax-regime records of the same company."""
    return companies.join(simples_by_company(simples), ROOT, "left").select(
        *RAW_COLUMNS["companies"],
        "simples_option",
        yes_no_to_boolean("simples_option").alias("is_simples"),
        "simples_option_date",
        "simples_exclusion_date",
        "mei_option",
        yes_no_to_boolean("mei_option").alias("is_mei"),
        "mei_option_date",
        "mei_exclusion_date",
    )


def establishment_activity(establishments: DataFrame) -> DataFrame:
    """Establishments with headquarters, branch and activity flags beside their codes."""
    branch_type, status = F.col("branch_type_code"), F.col("registration_status_code")
    flags = {
        "branch_type_code": {
            "is_headquarters": equals_flag(branch_type, HEADQUARTERS),
            "is_branch": equals_flag(branch_type, BRANCH),
        },
        "registration_status_code": {"is_active": equals_flag(status, ACTIVE)},
    }
    columns = []
    for name in (FULL, *RAW_COLUMNS["establishments"]):
        columns.append(F.col(name))
        columns += [flag.alias(alias) for alias, flag in flags.get(name, {}).items()]
    return establishments.select(*columns)


def partner_metrics(partners: DataFrame) -> DataFrame:
    """Partner counts by kind and first and latest start per company."""
    kind, start = F.col("partner_identifier_code"), F.col("partnership_start_date")
    return (
        partners.filter(F.col(ROOT).isNotNull())
        .groupBy(ROOT)
        .agg(
            F.count(F.lit(1)).alias("partner_count"),
            *(F.count_if(kind == code).alias(f"{k}_partner_count") for k, code in PARTNER_KINDS.items()),
            F.min(start).alias("first_partnership_start_date"),
            F.max(start).alias("latest_partnership_start_date"),
        )
    )


def active_company_base(
    activity: DataFrame, profile: DataFrame, partners: DataFrame
) -> DataFrame:
    """Active establishments with their company's profile and partner metrics.

    Only active rows and only the columns of the result enter the joins; both joins use the
    company key, so the establishments are shuffled once. ``profile`` and ``partners`` should be
    written tables: adaptive execution splits a hot company only where both sides of a join
    come straight from a shuffle, not where the right side is still a join or an aggregation.
    """
    active = activity.filter("is_active")
    profile_columns = [c for c in profile.columns if c != ROOT]
    establishment_columns = (
        "branch_order", "branch_type_code", "is_headquarters", "is_branch", "trade_name",
        "registration_status_code", "is_active", "registration_status_date",
        "activity_start_date", "primary_cnae_code", "state", "municipality_code",
    )
    return (
        active.join(profile, ROOT, "left")
        .join(partners, ROOT, "left")
        .select(
            FULL,
            ROOT,
            *profile_columns,
            *(zero_if_null(F.col(c)).alias(c) for c in PARTNER_COUNTS),
            *PARTNER_DATES,
            *(active[c] for c in establishment_columns),
        )
    )
