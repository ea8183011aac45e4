"""Marts: three dimensions and the fact of active companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.labels import (
    ACTIVITY_LEVELS,
    BRANCH_TYPE_LABELS,
    COMPANY_SIZE_LABELS,
    REGISTRATION_STATUS_LABELS,
    activity_label,
    activity_prefix,
    any_true,
    capital_range,
    false_last,
    label_of,
    present_flag,
    zero_if_null,
)
from rollbook.plans.intermediate import PARTNER_COUNTS, PARTNER_DATES
from rollbook.plans.schemas import ACTIVITY_CODE, FULL, ROOT

# The columns of the fact, in order.
FACT_COLUMNS = (
    "company_root_cnpj", "representative_full_cnpj", "primary_cnae_code", "state",
    "municipality_code", "representative_branch_type_code", "legal_name", "legal_nature_code",
    "responsible_qualification_code", "company_size_code", "responsible_federative_entity",
    "is_simples", "is_mei", "active_company_count", "active_establishment_count",
    "active_headquarters_count", "active_branch_count", "share_capital_amount", "partner_count",
    "legal_entity_partner_count", "individual_partner_count", "foreign_partner_count",
    "first_partnership_start_date", "latest_partnership_start_date",
    "first_activity_start_date", "latest_registration_status_date",
)

_COMPANY_TEXT = (
    "legal_name", "legal_nature_code", "responsible_qualification_code", "company_size_code",
    "responsible_federative_entity",
)
_REPRESENTATIVE = ("branch_type_code", "primary_cnae_code", "state", "municipality_code")


def dim_cnaes(cnaes: DataFrame) -> DataFrame:
    code, description = F.col(ACTIVITY_CODE), F.col("cnae_description")
    return cnaes.select(
        code,
        description,
        *(activity_prefix(code, level).alias(f"cnae_{level}_code") for level in ACTIVITY_LEVELS),
        activity_label(code, description).alias("cnae_subclass_label"),
    )


def dim_companies(profile: DataFrame) -> DataFrame:
    derived = {
        "share_capital": ("share_capital_range", capital_range(F.col("share_capital"))),
        "company_size_code": (
            "company_size_label",
            label_of(F.col("company_size_code"), COMPANY_SIZE_LABELS),
        ),
    }
    columns = []
    for name in profile.columns:
        if name not in ("simples_option", "mei_option"):
            columns.append(F.col(name))
        if name in derived:
            alias, column = derived[name]
            columns.append(column.alias(alias))
    return profile.select(*columns)


def dim_establishments(activity: DataFrame, cnaes: DataFrame) -> DataFrame:
    """Establishments with labels, contact flags and the description of their main activity.

    The activity table is broadcast only when its measured size is below Spark's threshold;
    beyond it the sort-merge join splits the popular activity codes at run time.
    """
    descriptions = cnaes.select(
        F.col(ACTIVITY_CODE).alias("primary_cnae_code"),
        F.col("cnae_description").alias("primary_cnae_description"),
    )
    after = {
        "branch_type_code": [
            label_of(F.col("branch_type_code"), BRANCH_TYPE_LABELS).alias("branch_type_label")
        ],
        "registration_status_code": [
            label_of(F.col("registration_status_code"), REGISTRATION_STATUS_LABELS).alias(
                "registration_status_label"
            )
        ],
        "primary_cnae_code": [F.col("primary_cnae_description")],
        "phone_2": [present_flag(F.col("phone_1"), F.col("phone_2")).alias("has_phone")],
        "email": [present_flag(F.col("email")).alias("has_email")],
    }
    columns = []
    for name in activity.columns:
        columns += [F.col(name), *after.get(name, ())]
    return activity.join(descriptions, "primary_cnae_code", "left").select(*columns)


def representative_establishments(base: DataFrame) -> DataFrame:
    """One active establishment per company: headquarters first, then the lowest number.

    The rank filter sits on the window, so each task keeps its own best row per company
    before anything is shuffled.
    """
    order = Window.partitionBy(ROOT).orderBy(
        false_last(F.col("is_headquarters")), FULL, *_REPRESENTATIVE
    )
    return (
        base.select(ROOT, FULL, "is_headquarters", *_REPRESENTATIVE)
        .withColumn("establishment_rank", F.row_number().over(order))
        .filter("establishment_rank = 1")
    )


def distinct_counts(base: DataFrame) -> DataFrame:
    """Distinct establishments, headquarters and municipalities of each company, in two levels.

    A row counts for two values, its number (with whether it is a headquarters, so headquarters
    need no value of their own) and its municipality. Equal ones of a company meet first, which
    spreads a hot company over all reducers; then its distinct values are plain counts.
    """
    values = base.selectExpr(
        ROOT,
        f"inline(array(struct(true AS is_number, {FULL} AS value, is_headquarters AS is_headquarters), "
        "struct(false AS is_number, municipality_code AS value, false AS is_headquarters)))",
    )
    distinct = values.groupBy(ROOT, "is_number", "value").agg(any_true(F.col("is_headquarters")).alias("is_headquarters"))
    known, number = F.col("value").isNotNull(), F.col("is_number")
    return distinct.groupBy(ROOT).agg(
        F.count_if(known & number).alias("active_establishment_count"),
        F.count_if(known & number & F.col("is_headquarters")).alias("headquarters_count"),
        F.count_if(known & ~number).alias("municipality_count"),
    )


def _establishment_measures(rows: DataFrame, *company_measures) -> DataFrame:
    """Company-level measures of active establishments, in two aggregations.

    The first is by establishment, which makes the three distinct counts plain counts and
    spreads the rows of a hot company over all reducers; the second sees one partial row per
    company and task. ``company_measures`` are aggregates that repeat safely at both levels.
    """
    pick = F.struct(false_last(F.col("is_headquarters")).alias("rank"), *_REPRESENTATIVE)
    by_establishment = rows.groupBy(ROOT, FULL).agg(
        F.min(pick).alias("pick"),
        any_true(F.col("is_headquarters")).alias("is_headquarters"),
        any_true(F.col("is_branch")).alias("is_branch"),
        F.min("activity_start_date").alias("first_activity_start_date"),
        F.max("registration_status_date").alias("latest_registration_status_date"),
        *(aggregate(source).alias(alias) for alias, source, aggregate in company_measures),
    )
    known = F.col(FULL).isNotNull()
    best = F.struct("pick.rank", FULL, *(f"pick.{c}" for c in _REPRESENTATIVE))
    return by_establishment.groupBy(ROOT).agg(
        F.min(best).alias("best"),
        F.count(FULL).alias("active_establishment_count"),
        F.count_if(known & F.col("is_headquarters")).alias("active_headquarters_count"),
        F.count_if(known & F.col("is_branch")).alias("active_branch_count"),
        F.min("first_activity_start_date").alias("first_activity_start_date"),
        F.max("latest_registration_status_date").alias("latest_registration_status_date"),
        *(aggregate(F.col(alias)).alias(alias) for alias, _, aggregate in company_measures),
    )


def _profile_measures() -> list:
    """(alias, source, aggregate) of the profile columns each establishment row repeats."""
    return [
        *((name, F.col(name), F.max) for name in _COMPANY_TEXT),
        *((name, F.col(name), any_true) for name in ("is_simples", "is_mei")),
        ("share_capital_amount", zero_if_null(F.col("share_capital")), F.max),
    ]


def _partner_measures() -> list:
    """(alias, source, aggregate) of the partner metrics each establishment row repeats."""
    first, latest = PARTNER_DATES
    return [
        *((name, zero_if_null(F.col(name)), F.max) for name in PARTNER_COUNTS),
        (first, F.col(first), F.min),
        (latest, F.col(latest), F.max),
    ]


def _as_fact(measures: DataFrame) -> DataFrame:
    return (
        measures.withColumn("representative_full_cnpj", F.col(f"best.{FULL}"))
        .withColumn("representative_branch_type_code", F.col("best.branch_type_code"))
        .withColumns({c: F.col(f"best.{c}") for c in _REPRESENTATIVE[1:]})
        .withColumn("active_company_count", F.lit(1))
        .select(*FACT_COLUMNS)
    )


def fct_active_companies(base: DataFrame) -> DataFrame:
    """One row per active company, from the written active base."""
    return _as_fact(_establishment_measures(base, *_profile_measures(), *_partner_measures()))


def fct_active_companies_from_parts(
    activity: DataFrame, profile: DataFrame, partners: DataFrame
) -> DataFrame:
    """The same fact straight from the parts, with no establishment-level join.

    Establishments are reduced to one row per company first; profile and partner metrics join
    at that grain, on the partitioning the aggregation left behind. Every company measure is
    idempotent (max, min, or), so joining after the roll-up gives the same values.
    """
    measures = _establishment_measures(activity.filter("is_active"))
    company = profile.groupBy(ROOT).agg(
        *(aggregate(source).alias(alias) for alias, source, aggregate in _profile_measures())
    )
    joined = measures.join(company, ROOT, "left").join(partners, ROOT, "left")
    zeros = ("share_capital_amount", *PARTNER_COUNTS)
    return _as_fact(
        joined.withColumns({c: zero_if_null(F.col(c)) for c in zeros}).withColumns(
            {c: F.coalesce(F.col(c), F.lit(False)) for c in ("is_simples", "is_mei")}
        )
    )
