"""Staging models: one standardized frame per raw source. All of them are map-only."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.standardize import (
    clean_lower,
    clean_text,
    clean_upper,
    establishment_key,
    parse_amount,
    parse_compact_date,
    standardize_code,
)
from rollbook.plans.schemas import ACTIVITY_CODE, FULL, RAW_COLUMNS, ROOT

# Width of every standardized code.
CODE_WIDTHS = {
    "cnaes": {"cnae_code": 7},
    "simples": {"company_root_cnpj": 8},
    "companies": {
        "company_root_cnpj": 8,
        "legal_nature_code": 4,
        "responsible_qualification_code": 2,
        "company_size_code": 2,
    },
    "establishments": {
        "company_root_cnpj": 8,
        "branch_order": 4,
        "check_digits": 2,
        "registration_status_code": 2,
        "registration_status_reason_code": 2,
        "country_code": 3,
        "primary_cnae_code": 7,
        "postal_code": 8,
        "municipality_code": 4,
    },
    "partners": {
        "company_root_cnpj": 8,
        "partner_qualification_code": 2,
        "country_code": 3,
        "legal_representative_qualification_code": 2,
    },
}


def _standardized(
    raw: DataFrame,
    source: str,
    amounts: Collection[str] = (),
    upper: Collection[str] = (),
    lower: Collection[str] = (),
) -> DataFrame:
    """Every source column in file order, each under the rule for its kind.

    Codes are listed by width, dates are known by their suffix, and a column with no rule
    of its own is cleaned text.
    """
    widths: Mapping[str, int] = CODE_WIDTHS[source]

    def rule(name: str) -> Column:
        if name in widths:
            return standardize_code(name, widths[name])
        if name.endswith("_date"):
            return parse_compact_date(name)
        if name in amounts:
            return parse_amount(name)
        if name in upper:
            return clean_upper(name)
        if name in lower:
            return clean_lower(name)
        return clean_text(name)

    return raw.select(*(rule(name).alias(name) for name in RAW_COLUMNS[source]))


def stg_cnaes(raw: DataFrame) -> DataFrame:
    return _standardized(raw, "cnaes").filter(F.col(ACTIVITY_CODE).isNotNull())


def stg_simples(raw: DataFrame) -> DataFrame:
    return _standardized(raw, "simples").filter(F.col(ROOT).isNotNull())


def stg_companies(raw: DataFrame) -> DataFrame:
    return _standardized(raw, "companies", amounts=("share_capital",)).filter(
        F.col(ROOT).isNotNull()
    )


def stg_establishments(raw: DataFrame) -> DataFrame:
    rows = _standardized(raw, "establishments", upper=("state",), lower=("email",))
    key = establishment_key(ROOT, "branch_order", "check_digits")
    return rows.select(key.alias(FULL), "*").filter(F.col(FULL).isNotNull())


def stg_partners(raw: DataFrame) -> DataFrame:
    return _standardized(raw, "partners").filter(F.col(ROOT).isNotNull())


STAGING = {
    "cnaes": stg_cnaes,
    "simples": stg_simples,
    "companies": stg_companies,
    "establishments": stg_establishments,
    "partners": stg_partners,
}
