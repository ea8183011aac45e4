"""The SQL each registered query is compared with, for an engine that is not Spark.

The statements state results in their own way (filtered aggregates, ``distinct on``, ``using``)
and share nothing with the library but the projection of the given tables.
"""

from __future__ import annotations

import re

from checks.inputs import (
    AS_OF,
    GIVEN,
    LOADED_AT,
    RAW,
    RELEASES,
    RUN_IDS,
    SECOND_COMPANIES,
    SECOND_STATE,
    SECOND_STATUS,
    THIRD_COMPANIES,
)
from rollbook.plans.schemas import raw_table


def text(x: str) -> str:
    return f"nullif(trim({x}), '')"


def code(x: str, width: int) -> str:
    return f"lpad({text(x)}, {width}, '0')"


def day(x: str) -> str:
    return f"cast(try_strptime({text(x)}, '%Y%m%d') as date)"


def amount(x: str) -> str:
    return f"try_cast(replace({text(x)}, ',', '.') as decimal(18,2))"


def flag(condition: str) -> str:
    return f"coalesce({condition}, false)"


def named(**columns: str) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in columns.items())


def texts(names: str) -> str:
    return named(**{n: text(n) for n in names.split()})


def days(names: str) -> str:
    return named(**{n: day(n) for n in names.split()})


def size_label(x: str) -> str:
    return (
        f"coalesce(map {{'00': 'not_informed', '01': 'micro_company', '03': 'small_company',"
        f" '05': 'other'}}[{x}], 'unknown')"
    )


def branch_label(x: str) -> str:
    return f"coalesce(map {{'1': 'headquarters', '2': 'branch'}}[{x}], 'unknown')"


def status_label(x: str) -> str:
    return (
        f"coalesce(map {{'01': 'null', '02': 'active', '03': 'suspended', '04': 'unsuitable',"
        f" '08': 'closed'}}[{x}], 'unknown')"
    )


def capital_range(x: str) -> str:
    return (
        f"if({x} < 10000, 'up_to_10k', if({x} < 100000, '10k_to_100k',"
        f" if({x} < 1000000, '100k_to_1m', 'over_1m')))"
    )


def companies_sql(raw: str) -> str:
    return f"""
        select {code('company_root_cnpj', 8)} as company_root_cnpj, {texts('legal_name')},
               {code('legal_nature_code', 4)} as legal_nature_code,
               {code('responsible_qualification_code', 2)} as responsible_qualification_code,
               {amount('share_capital')} as share_capital,
               {code('company_size_code', 2)} as company_size_code,
               {texts('responsible_federative_entity')}
        from {raw} where {text('company_root_cnpj')} is not null
    """


def profile_sql(companies: str) -> str:
    return f"""
        select company_root_cnpj, legal_name, legal_nature_code, responsible_qualification_code,
               share_capital, company_size_code, responsible_federative_entity, simples_option,
               {flag("upper(simples_option) = 'S'")} as is_simples, simples_option_date,
               simples_exclusion_date, mei_option, {flag("upper(mei_option) = 'S'")} as is_mei,
               mei_option_date, mei_exclusion_date
        from {companies} left join simples_rollup using (company_root_cnpj)
    """


def establishments_sql(raw: str) -> str:
    parts = (code("company_root_cnpj", 8), code("branch_order", 4), code("check_digits", 2))
    return f"""
        select {' || '.join(parts)} as full_cnpj, {parts[0]} as company_root_cnpj,
               {parts[1]} as branch_order, {parts[2]} as check_digits,
               {texts('branch_type_code trade_name')},
               {code('registration_status_code', 2)} as registration_status_code,
               {days('registration_status_date')},
               {code('registration_status_reason_code', 2)} as registration_status_reason_code,
               {texts('foreign_city_name')}, {code('country_code', 3)} as country_code,
               {days('activity_start_date')}, {code('primary_cnae_code', 7)} as primary_cnae_code,
               {texts('secondary_cnae_codes street_type street_name address_number')},
               {texts('address_complement district')}, {code('postal_code', 8)} as postal_code,
               upper({text('state')}) as state, {code('municipality_code', 4)} as municipality_code,
               {texts('area_code_1 phone_1 area_code_2 phone_2 fax_area_code fax_number')},
               lower({text('email')}) as email, {texts('special_status')},
               {days('special_status_date')}
        from {raw} where {' || '.join(parts)} is not null
    """


ACTIVITY_COLUMNS = """
    full_cnpj, company_root_cnpj, branch_order, check_digits, branch_type_code,
    coalesce(branch_type_code = '1', false) as is_headquarters,
    coalesce(branch_type_code = '2', false) as is_branch, trade_name, registration_status_code,
    coalesce(registration_status_code = '02', false) as is_active,
    * exclude (full_cnpj, company_root_cnpj, branch_order, check_digits, branch_type_code,
               trade_name, registration_status_code)
"""


def base_sql(activity: str, profile: str = "company_profile") -> str:
    return f"""
        select e.full_cnpj, e.company_root_cnpj, p.* exclude (company_root_cnpj),
               ifnull(m.partner_count, 0) as partner_count,
               ifnull(m.legal_entity_partner_count, 0) as legal_entity_partner_count,
               ifnull(m.individual_partner_count, 0) as individual_partner_count,
               ifnull(m.foreign_partner_count, 0) as foreign_partner_count,
               m.first_partnership_start_date, m.latest_partnership_start_date,
               e.branch_order, e.branch_type_code, e.is_headquarters, e.is_branch, e.trade_name,
               e.registration_status_code, e.is_active, e.registration_status_date,
               e.activity_start_date, e.primary_cnae_code, e.state, e.municipality_code
        from (from {activity} where is_active) e
        left join {profile} p on p.company_root_cnpj = e.company_root_cnpj
        left join partner_metrics m on m.company_root_cnpj = e.company_root_cnpj
    """


BEST_FIRST = """is_headquarters desc, full_cnpj, branch_type_code, primary_cnae_code, state,
                municipality_code"""


def fact_sql(base: str) -> str:
    return f"""
        select company_root_cnpj, best.full_cnpj as representative_full_cnpj,
               best.primary_cnae_code, best.state, best.municipality_code,
               best.branch_type_code as representative_branch_type_code,
               totals.* exclude (company_root_cnpj)
        from (
            select company_root_cnpj, max(legal_name) as legal_name,
                   max(legal_nature_code) as legal_nature_code,
                   max(responsible_qualification_code) as responsible_qualification_code,
                   max(company_size_code) as company_size_code,
                   max(responsible_federative_entity) as responsible_federative_entity,
                   ifnull(bool_or(is_simples), false) as is_simples,
                   ifnull(bool_or(is_mei), false) as is_mei,
                   1 as active_company_count,
                   count(distinct full_cnpj) as active_establishment_count,
                   count(distinct full_cnpj) filter (where is_headquarters)
                       as active_headquarters_count,
                   count(distinct full_cnpj) filter (where is_branch) as active_branch_count,
                   ifnull(max(share_capital), 0.00) as share_capital_amount,
                   max(partner_count) as partner_count,
                   max(legal_entity_partner_count) as legal_entity_partner_count,
                   max(individual_partner_count) as individual_partner_count,
                   max(foreign_partner_count) as foreign_partner_count,
                   min(first_partnership_start_date) as first_partnership_start_date,
                   max(latest_partnership_start_date) as latest_partnership_start_date,
                   min(activity_start_date) as first_activity_start_date,
                   max(registration_status_date) as latest_registration_status_date
            from {base} group by all
        ) totals
        join (
            select distinct on (company_root_cnpj) *
            from {base} order by company_root_cnpj, {BEST_FIRST}
        ) best using (company_root_cnpj)
    """


CAPITAL_COLUMNS = """company_root_cnpj, legal_name, legal_nature_code, share_capital,
    company_size_code, is_simples, is_mei"""


def opened(source: str, release: int) -> str:
    moment = f"{RELEASES[release]} 00:00:00"
    return f"""
        select {CAPITAL_COLUMNS}, md5(company_root_cnpj || '|{moment}') as dbt_scd_id,
               timestamp '{moment}' as dbt_updated_at, timestamp '{moment}' as dbt_valid_from,
               cast(null as timestamp) as dbt_valid_to
        from {source}
    """


def advanced(history: str, source: str, release: int) -> str:
    """The history after a release: every old row, perhaps closed, and every new version."""
    same = f"""exists (from {source} s where s.company_root_cnpj = h.company_root_cnpj
                       and s.share_capital is not distinct from h.share_capital)"""
    return f"""
        select h.* replace (if(h.dbt_valid_to is null and not {same},
                               timestamp '{RELEASES[release]} 00:00:00', h.dbt_valid_to)
                            as dbt_valid_to)
        from {history} h
        union all
        {opened(source, release)} n
        where not exists (
            from {history} h
            where h.dbt_valid_to is null and h.company_root_cnpj = n.company_root_cnpj
              and h.share_capital is not distinct from n.share_capital)
    """


def stamped(raw: str, release: int) -> str:
    return f"""
        select *, timestamp '{LOADED_AT[release]}' as _loaded_at,
               date '{RELEASES[release]}' as _source_reference_date,
               '{RUN_IDS[release]}' as _pipeline_run_id
        from {raw}
    """


TABLES: dict[str, str] = {
    **{f"raw_{s}": RAW[s].format(**{GIVEN[s]: GIVEN[s]}) for s in RAW},
    "raw_companies_2": SECOND_COMPANIES.format(companies="raw_companies"),
    "raw_companies_3": THIRD_COMPANIES.format(companies="raw_companies", second="raw_companies_2"),
    "raw_establishments_2": f"""
        select * replace ({SECOND_STATUS} as registration_status_code, {SECOND_STATE} as state)
        from raw_establishments
    """,
    "stg_cnaes": f"""
        select {code('cnae_code', 7)} as cnae_code, {texts('cnae_description')}
        from raw_cnaes where {text('cnae_code')} is not null
    """,
    "stg_simples": f"""
        select {code('company_root_cnpj', 8)} as company_root_cnpj, {texts('simples_option')},
               {days('simples_option_date simples_exclusion_date')}, {texts('mei_option')},
               {days('mei_option_date mei_exclusion_date')}
        from raw_simples where {text('company_root_cnpj')} is not null
    """,
    "stg_companies": companies_sql("raw_companies"),
    "stg_companies_2": companies_sql("raw_companies_2"),
    "stg_companies_3": companies_sql("raw_companies_3"),
    "stg_establishments": establishments_sql("raw_establishments"),
    "stg_establishments_2": establishments_sql("raw_establishments_2"),
    "stg_partners": f"""
        select {code('company_root_cnpj', 8)} as company_root_cnpj,
               {texts('partner_identifier_code partner_name partner_document')},
               {code('partner_qualification_code', 2)} as partner_qualification_code,
               {days('partnership_start_date')}, {code('country_code', 3)} as country_code,
               {texts('legal_representative_document legal_representative_name')},
               {code('legal_representative_qualification_code', 2)}
                   as legal_representative_qualification_code,
               {texts('partner_age_range_code')}
        from raw_partners where {text('company_root_cnpj')} is not null
    """,
    "simples_rollup": """
        select company_root_cnpj, max(simples_option) as simples_option,
               max(mei_option) as mei_option, min(simples_option_date) as simples_option_date,
               min(mei_option_date) as mei_option_date,
               max(simples_exclusion_date) as simples_exclusion_date,
               max(mei_exclusion_date) as mei_exclusion_date
        from stg_simples group by all
    """,
    "company_profile": profile_sql("stg_companies"),
    "company_profile_2": profile_sql("stg_companies_2"),
    "company_profile_3": profile_sql("stg_companies_3"),
    "establishment_activity": f"select {ACTIVITY_COLUMNS} from stg_establishments",
    "establishment_activity_2": f"select {ACTIVITY_COLUMNS} from stg_establishments_2",
    "partner_metrics": """
        select company_root_cnpj, count(*) as partner_count,
               count(*) filter (where partner_identifier_code = '1') as legal_entity_partner_count,
               count(*) filter (where partner_identifier_code = '2') as individual_partner_count,
               count(*) filter (where partner_identifier_code = '3') as foreign_partner_count,
               min(partnership_start_date) as first_partnership_start_date,
               max(partnership_start_date) as latest_partnership_start_date
        from stg_partners group by all
    """,
    "active_company_base": base_sql("establishment_activity"),
    "active_company_base_2": base_sql("establishment_activity_2"),
    "active_company_base_of_second_companies": base_sql("establishment_activity", "company_profile_2"),
    "dim_cnaes": """
        select cnae_code, cnae_description, cnae_code[:2] as cnae_division_code,
               cnae_code[:3] as cnae_group_code, cnae_code[:5] as cnae_class_code,
               cnae_code[:7] as cnae_subclass_code,
               cnae_code || ' - ' || cnae_description as cnae_subclass_label
        from stg_cnaes
    """,
    "dim_companies": f"""
        select * exclude (simples_option, mei_option),
               {capital_range('share_capital')} as share_capital_range,
               {size_label('company_size_code')} as company_size_label
        from company_profile
    """,
    "dim_establishments": f"""
        select a.*, {branch_label('branch_type_code')} as branch_type_label,
               {status_label('registration_status_code')} as registration_status_label,
               c.cnae_description as primary_cnae_description,
               coalesce(phone_1, phone_2) is not null as has_phone, email is not null as has_email
        from establishment_activity a left join dim_cnaes c on a.primary_cnae_code = c.cnae_code
    """,
    "fct_active_companies": fact_sql("active_company_base"),
    "fct_second": fact_sql("active_company_base_2"),
    "fct_of_second_companies": fact_sql("active_company_base_of_second_companies"),
    "history_1": opened("company_profile", 0),
    "share_capital_snapshot": "from history_1",
    "history_2": advanced("history_1", "company_profile_2", 1),
    "history_3": advanced("history_2", "company_profile_3", 2),
    "stored": f"{stamped('raw_companies', 0)} union all {stamped('raw_companies_2', 1)}",
}

_FACT_MEASURES = """company_root_cnpj, active_company_count, active_establishment_count,
    active_headquarters_count, active_branch_count, share_capital_amount, partner_count,
    legal_entity_partner_count, individual_partner_count, foreign_partner_count"""


def nulls(table: str, *columns: str) -> list[str]:
    return [
        f"select '{table}', '{c}', 'not_null', count(*) from {table} where {c} is null"
        for c in columns
    ]


def repeats(table: str, column: str) -> str:
    return f"""select '{table}', '{column}', 'unique', count(*) from (
        select {column} from {table} where {column} is not null
        group by {column} having count(*) > 1)"""


def strangers(table: str, column: str, values: str) -> str:
    return f"""select '{table}', '{column}', 'accepted_values', count(*) from {table}
        where {column} not in ({values})"""


def orphans(table: str, column: str, parent: str, field: str) -> str:
    return f"""select '{table}', '{column}', 'relationships', count(*) from {table}
        where {column} is not null and not exists (
            from {parent} where {parent}.{field} = {table}.{column})"""


CONTRADICTION = """active_company_count != 1 or active_establishment_count < 1
    or active_headquarters_count + active_branch_count != active_establishment_count
    or greatest(active_headquarters_count, active_branch_count) > active_establishment_count
    or share_capital_amount < 0
    or legal_entity_partner_count + individual_partner_count + foreign_partner_count
       != partner_count"""

KEY = "company_root_cnpj"
SUITE = [
    *nulls("stg_cnaes", "cnae_code", "cnae_description"),
    *nulls("stg_simples", KEY),
    *nulls("stg_companies", KEY, "legal_name", "legal_nature_code", "share_capital"),
    *nulls("stg_establishments", "full_cnpj", KEY, "branch_order", "check_digits",
           "primary_cnae_code"),
    *nulls("stg_partners", KEY, "partner_identifier_code", "partner_qualification_code"),
    *nulls("company_profile", KEY),
    *nulls("establishment_activity", "full_cnpj", KEY, "primary_cnae_code"),
    *nulls("partner_metrics", KEY, "partner_count"),
    *nulls("active_company_base", "full_cnpj", KEY, "primary_cnae_code", "partner_count"),
    *nulls("dim_cnaes", "cnae_code", "cnae_description", "cnae_division_code", "cnae_group_code",
           "cnae_class_code", "cnae_subclass_code"),
    *nulls("dim_companies", KEY, "legal_name", "legal_nature_code", "share_capital", "is_simples",
           "is_mei"),
    *nulls("dim_establishments", "full_cnpj", KEY, "branch_order", "is_headquarters", "is_branch",
           "is_active", "primary_cnae_code", "primary_cnae_description", "has_phone", "has_email"),
    *nulls("fct_active_companies", KEY, "representative_full_cnpj", "primary_cnae_code",
           "is_simples", "is_mei", "active_company_count", "active_establishment_count",
           "active_headquarters_count", "active_branch_count", "share_capital_amount",
           "partner_count", "legal_entity_partner_count", "individual_partner_count",
           "foreign_partner_count"),
    *nulls("share_capital_snapshot", KEY, "share_capital", "dbt_scd_id", "dbt_valid_from"),
    repeats("stg_cnaes", "cnae_code"),
    repeats("stg_companies", KEY),
    repeats("stg_establishments", "full_cnpj"),
    repeats("company_profile", KEY),
    repeats("establishment_activity", "full_cnpj"),
    repeats("partner_metrics", KEY),
    repeats("active_company_base", "full_cnpj"),
    repeats("dim_cnaes", "cnae_code"),
    repeats("dim_companies", KEY),
    repeats("dim_establishments", "full_cnpj"),
    repeats("fct_active_companies", KEY),
    repeats("share_capital_snapshot", "dbt_scd_id"),
    strangers("stg_simples", "simples_option", "'S', 'N'"),
    strangers("stg_simples", "mei_option", "'S', 'N'"),
    strangers("stg_companies", "company_size_code", "'00', '01', '03', '05'"),
    strangers("stg_establishments", "branch_type_code", "'1', '2'"),
    strangers("stg_establishments", "registration_status_code", "'01', '02', '03', '04', '08'"),
    strangers("stg_partners", "partner_identifier_code", "'1', '2', '3'"),
    strangers("dim_companies", "share_capital_range",
              "'up_to_10k', '10k_to_100k', '100k_to_1m', 'over_1m'"),
    strangers("dim_companies", "company_size_code", "'00', '01', '03', '05'"),
    strangers("dim_companies", "company_size_label",
              "'not_informed', 'micro_company', 'small_company', 'other', 'unknown'"),
    strangers("dim_establishments", "branch_type_code", "'1', '2'"),
    strangers("dim_establishments", "branch_type_label", "'headquarters', 'branch', 'unknown'"),
    strangers("dim_establishments", "registration_status_code", "'01', '02', '03', '04', '08'"),
    strangers("dim_establishments", "registration_status_label",
              "'null', 'active', 'suspended', 'unsuitable', 'closed', 'unknown'"),
    strangers("fct_active_companies", "representative_branch_type_code", "'1', '2'"),
    strangers("fct_active_companies", "company_size_code", "'00', '01', '03', '05'"),
    strangers("fct_active_companies", "active_company_count", "1"),
    orphans("establishment_activity", "primary_cnae_code", "stg_cnaes", "cnae_code"),
    orphans("active_company_base", "primary_cnae_code", "stg_cnaes", "cnae_code"),
    orphans("dim_establishments", "primary_cnae_code", "dim_cnaes", "cnae_code"),
    orphans("fct_active_companies", "representative_full_cnpj", "dim_establishments", "full_cnpj"),
    orphans("fct_active_companies", "primary_cnae_code", "dim_cnaes", "cnae_code"),
    f"""select 'fct_active_companies', '*', 'active_company_metrics_are_consistent', count(*)
        from fct_active_companies where {CONTRADICTION}""",
]

_DAY = "registration_status_date"
_ORDER0 = "nullif(branch_order, '0')"
_TYPE = "nullif(branch_type_code, '2')"

RESULTS: dict[str, str] = {
    **{f"raw_{s}": f"from raw_{s}" for s in RAW},
    **{f"stg_{s}": f"from stg_{s}" for s in RAW},
    "expr_clean_text": f"""
        select doc_id, {text('text')} as text,
               {text("chr(160) || text || '  '")} as padded_text, {text('lang')} as lang,
               {text('cast(n_chars as varchar)')} as n_chars
        from documents
    """,
    "expr_clean_upper_lower": f"""
        select postal_code, upper({text('state')}) as state, lower({text('email')}) as email,
               upper({text('trade_name')}) as upper_name,
               lower({text('street_name')}) as lower_street
        from raw_establishments
    """,
    "expr_standardize_code": f"""
        select postal_code, {code('company_root_cnpj', 8)} as padded_root,
               {code('trade_name', 4)} as cut_name, {code('state', 2)} as exact_state,
               {code('country_code', 3)} as country, {code('district', 20)} as padded_district
        from raw_establishments
    """,
    "expr_parse_date": f"""
        select postal_code, {day(_DAY)} as eight_digits,
               {day('activity_start_date')} as no_such_day,
               {day('special_status_date')} as filler,
               {day(f'{_DAY}[:7]')} as seven_digits, {day(f'{_DAY}[:6]')} as six_digits,
               {day(f"{_DAY} || '1'")} as nine_digits,
               {day(f"chr(9) || {_DAY} || ' '")} as tab_before,
               {day(f"{_DAY}[:4] || '-' || {_DAY}[5:6] || '-' || {_DAY}[7:8]")} as dashed,
               {day('trade_name')} as words
        from raw_establishments
    """,
    "expr_yes_no": f"""
        select company_root_cnpj, simples_option_date,
               {flag("upper(trim(simples_option)) = 'S'")} as is_simples,
               {flag("upper(trim(mei_option)) = 'S'")} as is_mei,
               {flag("upper(trim(lower(mei_option))) = 'S'")} as is_mei_lower,
               {flag("upper(trim(nullif(simples_option, 'N'))) = 'S'")} as is_simples_null
        from raw_simples
    """,
    "expr_decimal_comma": f"""
        select company_root_cnpj, {amount('share_capital')} as amount,
               {amount("' -' || share_capital || '5 '")} as negative_rounded,
               {amount("'1.' || share_capital")} as thousands_dot,
               {amount("share_capital || 'e3'")} as exponent,
               {amount("'99999999999999' || share_capital")} as too_large,
               {amount('legal_name')} as words
        from raw_companies
    """,
    "expr_concat_key": f"""
        select postal_code, company_root_cnpj || {_ORDER0} || check_digits as full_cnpj
        from raw_establishments
    """,
    "expr_code_hierarchy": """
        select cnae_code, left(cnae_code, 2) as division, left(cnae_code, 3) as "group",
               left(cnae_code, 5) as class, left(cnae_code, 7) as subclass,
               cnae_code || ' - ' || nullif(cnae_description, '') as label,
               if(cnae_code > '0001000', cnae_code || ' - ' || cnae_description, null)
                   as half_label
        from stg_cnaes
    """,
    "expr_capital_range": f"""
        select company_root_cnpj, {capital_range('share_capital')} as capital_range,
               {capital_range('(-share_capital)')} as negative_range
        from stg_companies
    """,
    "expr_code_labels": f"""
        select kind, code, label, count(*) as rows from (
            select 'size' as kind, company_size_code as code,
                   {size_label('company_size_code')} as label from stg_companies
            union all
            select 'branch', branch_type_code, {branch_label('branch_type_code')}
            from stg_establishments
            union all
            select 'status', registration_status_code, {status_label('registration_status_code')}
            from stg_establishments
        ) group by all
    """,
    "expr_presence_flags": """
        select full_cnpj, coalesce(phone_1, phone_2) is not null as has_phone,
               email is not null as has_email
        from stg_establishments
    """,
    "expr_equality_flags": f"""
        select full_cnpj, {flag(f"{_TYPE} = '1'")} as is_headquarters,
               {flag(f"{_TYPE} = '2'")} as is_branch,
               {flag("registration_status_code = '02'")} as is_active
        from stg_establishments
    """,
    "expr_defaults_and_constants": """
        select company_root_cnpj, ifnull(share_capital, 0.00) as share_capital_amount,
               1 as active_company_count, if(is_mei, 0, 1) as mei_sort_key,
               company_size_code <> '01' as not_micro
        from company_profile
    """,
    "filter_null_keys": f"""
        select {code("nullif(simples_option, 'N')", 8)} as company_root_cnpj,
               {texts('simples_option')}, {days('simples_option_date simples_exclusion_date')},
               {texts('mei_option')}, {days('mei_option_date mei_exclusion_date')}
        from raw_simples where {text("nullif(simples_option, 'N')")} is not null
    """,
    "filter_active": """
        select full_cnpj, company_root_cnpj, registration_status_code, state
        from establishment_activity where is_active
    """,
    "join_left_rollup": """
        from stg_companies left join simples_rollup using (company_root_cnpj)
    """,
    "join_left_chain": """
        select full_cnpj, company_root_cnpj, state, legal_name, is_simples,
               m.* exclude (company_root_cnpj)
        from establishment_activity
        left join company_profile using (company_root_cnpj)
        left join partner_metrics m using (company_root_cnpj)
    """,
    "join_left_small_dimension": """
        select full_cnpj, primary_cnae_code, cnae_subclass_label
        from establishment_activity left join dim_cnaes on primary_cnae_code = cnae_code
    """,
    "join_left_residual": f"""
        select company_root_cnpj, rows, full_cnpj, cast(1 as integer) as establishment_rank
        from (select company_root_cnpj, count(*) as rows from active_company_base group by all)
        join (select distinct on (company_root_cnpj) company_root_cnpj, full_cnpj
              from active_company_base order by company_root_cnpj, {BEST_FIRST})
        using (company_root_cnpj)
    """,
    "join_anti_orphans": """
        select primary_cnae_code as value, count(*) as occurrences from establishment_activity
        where primary_cnae_code not in (select cnae_code from stg_cnaes) group by all
    """,
    "agg_conditional_sum": """
        select company_root_cnpj, count(*) as partner_count,
               cast(sum(if(partner_identifier_code = '1', 1, 0)) as bigint)
                   as legal_entity_partner_count,
               cast(sum(if(partner_identifier_code = '2', 1, 0)) as bigint)
                   as individual_partner_count,
               cast(sum(if(partner_identifier_code = '3', 1, 0)) as bigint)
                   as foreign_partner_count
        from stg_partners group by all
    """,
    "agg_min_max": """
        select company_root_cnpj, min(activity_start_date) as first_activity_start_date,
               max(registration_status_date) as latest_registration_status_date,
               max(trade_name) as last_name
        from stg_establishments group by all
    """,
    "agg_distinct": """
        select company_root_cnpj, count(distinct full_cnpj) as active_establishment_count,
               count(distinct full_cnpj) filter (where is_headquarters) as headquarters_count,
               count(distinct municipality_code) as municipality_count
        from active_company_base group by all
    """,
    "agg_bool_or": """
        select company_root_cnpj, ifnull(bool_or(is_simples), false) as is_simples,
               ifnull(bool_or(is_mei), false) as is_mei,
               bool_or(is_headquarters) as has_headquarters
        from active_company_base group by all
    """,
    "agg_max_default": """
        select company_root_cnpj, ifnull(max(share_capital), 0.00) as share_capital_amount,
               max(legal_name) as legal_name, ifnull(max(partner_count), 0) as partner_count
        from active_company_base group by all
    """,
    "window_representative": f"""
        select company_root_cnpj, full_cnpj, is_headquarters, branch_type_code,
               primary_cnae_code, state, municipality_code,
               cast(row_number() over (partition by company_root_cnpj order by {BEST_FIRST})
                    as integer) as establishment_rank
        from active_company_base qualify establishment_rank = 1
    """,
    "int_company_profile": "from company_profile",
    "int_establishment_activity": "from establishment_activity",
    "int_partner_metrics": "from partner_metrics",
    "int_active_company_base": "from active_company_base",
    "dim_cnaes": "from dim_cnaes",
    "dim_companies": "from dim_companies",
    "dim_establishments": "from dim_establishments",
    "fct_active_companies": "from fct_active_companies",
    "fct_active_companies_from_base": "from fct_active_companies",
    "incremental_first_batch": "from fct_active_companies",
    "incremental_second_batch": """
        from fct_second union all
        from fct_active_companies
        where company_root_cnpj not in (select company_root_cnpj from fct_second)
    """,
    "incremental_one_changed_company": """
        select company_root_cnpj,
               if(company_root_cnpj = (select min(company_root_cnpj) from fct_active_companies),
                  'changed', legal_name) as legal_name,
               1 as new_files
        from fct_active_companies
    """,
    "incremental_schema_sync": f"""
        select * exclude (municipality_code), date '{RELEASES[1]}' as source_reference_date
        from fct_second
        union all by name
        select * exclude (municipality_code) from fct_active_companies
        where company_root_cnpj not in (select company_root_cnpj from fct_second)
    """,
    "scd2_initial": "from history_1",
    "scd2_second_release": "from history_2",
    "scd2_reappear": "from history_3",
    "scd2_history_lookup": """
        select company_root_cnpj, share_capital, dbt_valid_from, dbt_valid_to
        from history_3 where company_root_cnpj = '00000130' order by dbt_valid_from
    """,
    "dq_not_null": """
        select company_root_cnpj, legal_name from dim_companies where share_capital is null
    """,
    "dq_unique": """
        select company_root_cnpj as value, count(*) as occurrences
        from stg_simples group by all having count(*) > 1
    """,
    "dq_accepted_values": """
        select registration_status_code as value, count(*) as occurrences
        from stg_establishments
        where registration_status_code not in ('01', '02', '03', '04', '08') group by all
    """,
    "dq_relationships": """
        select f.primary_cnae_code as value, count(*) as occurrences
        from fct_active_companies f left join dim_cnaes c on c.cnae_code = f.primary_cnae_code
        where c.cnae_code is null and f.primary_cnae_code is not null group by all
    """,
    "dq_business_rule": f"""
        select {_FACT_MEASURES} from (
            select * replace (
                partner_count + if(state = 'SP', 1, 0) as partner_count,
                if(state = 'RJ', -share_capital_amount, share_capital_amount)
                    as share_capital_amount)
            from fct_active_companies)
        where {CONTRADICTION}
    """,
    "dq_suite": f"""
        select * from ({' union all '.join(SUITE)})
            as suite(table_name, column_name, test_name, failures)
    """,
    "serve_active_by_state_activity": """
        select state, primary_cnae_code, cast(sum(active_company_count) as bigint)
               as active_companies
        from fct_active_companies group by all
    """,
    "serve_active_in_state_release": """
        select state, primary_cnae_code, count(*) as active_companies
        from fct_active_companies where state = 'SP' group by all
    """,
    "serve_active_as_of": """
        select state, primary_cnae_code, cast(sum(active_company_count) as bigint)
               as active_companies
        from fct_second group by all
    """,
    "serve_company_lookup": "from dim_companies where company_root_cnpj = '00000042'",
    "serve_row_counts": " union all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}"
        for t in (*(f"raw_{s}" for s in RAW), "fct_active_companies")
    ),
    "serve_preview": "from dim_companies order by company_root_cnpj limit 10",
    "raw_append_only": "from stored",
    "raw_upsert": """
        from raw_companies_2 union all
        from raw_companies
        where company_root_cnpj not in (select company_root_cnpj from raw_companies_2)
    """,
    "raw_metadata": stamped("raw_companies", 0),
    "dedupe_current_state": """
        from stored qualify row_number() over (
            partition by company_root_cnpj order by _source_reference_date desc) = 1
    """,
    "partition_pruned": f"""
        select company_root_cnpj, share_capital, _source_reference_date
        from stored where _source_reference_date = date '{RELEASES[1]}'
    """,
    "layout_clustered": "from fct_active_companies",
    "layout_interleaved": "from fct_active_companies",
    "row_counts_by_run": """
        select 'companies' as source_name, _source_reference_date, _pipeline_run_id,
               count(*) as row_count
        from stored group by all
    """,
    "freshness_by_source": f"""
        select 'companies' as source_name, max(_source_reference_date) as latest_reference_date,
               cast(date '{AS_OF}' - max(_source_reference_date) as integer) as age_days
        from stored
    """,
    "invalid_and_late_records": f"""
        select _source_reference_date,
               count(*) filter (where trim(share_capital) <> ''
                                and {amount('share_capital')} is null) as invalid_share_capital,
               count(*) filter (where cast(_loaded_at as date) - _source_reference_date > 7)
                   as late_rows
        from stored group by all
    """,
    "ingest_zip_csv": "from raw_cnaes",
    "ingest_multi_archive": "from raw_establishments",
    "ingest_csv": "from stg_partners",
    "ingest_json": "from raw_simples",
    "ingest_row_limit": "from raw_companies order by cast(company_root_cnpj as bigint) limit 100",
    "ingest_json_pages": "from raw_companies",
    "ingest_malformed_json": """
        select 'row' as kind, company_root_cnpj as content from raw_companies
        where cast(company_root_cnpj as bigint) % 50 <> 0
        union all
        select 'rejected', '{broken ' || company_root_cnpj from raw_companies
        where cast(company_root_cnpj as bigint) % 50 = 0
        union all
        select if(cast(company_root_cnpj as bigint) % 50 = 0, 'rejects', 'rows'), cast(count(*) as varchar)
        from raw_companies group by 1
    """,
    "zip_member_choice": """
        select *, unnest(['named', 'unnamed']) as archive from raw_cnaes
    """,
    "zip_header": """
        select *, null as note from raw_companies where cast(company_root_cnpj as bigint) % 2 = 1
        union all by name
        select share_capital, company_root_cnpj, legal_name, 'even' as note
        from raw_companies where cast(company_root_cnpj as bigint) % 2 = 0
    """,
    "zip_row_width": """
        select * replace (
            if(cast(company_root_cnpj as bigint) % 3 = 0, null, share_capital) as share_capital,
            if(cast(company_root_cnpj as bigint) % 3 = 0, null, company_size_code) as company_size_code,
            if(cast(company_root_cnpj as bigint) % 3 = 0, null, responsible_federative_entity)
                as responsible_federative_entity)
        from raw_companies
    """,
    "zip_rejected_records": """
        select 'row' as kind, company_root_cnpj as content from raw_companies
        where cast(company_root_cnpj as bigint) % 3 = 2
        union all
        select 'rejected', concat_ws('|', company_root_cnpj, legal_name, legal_nature_code,
                                     responsible_qualification_code)
        from raw_companies where cast(company_root_cnpj as bigint) % 3 = 0
        union all
        select 'rejected', concat_ws('|', company_root_cnpj, legal_name, legal_nature_code,
                                     responsible_qualification_code, share_capital, company_size_code,
                                     responsible_federative_entity, 'more', '')
        from raw_companies where cast(company_root_cnpj as bigint) % 3 = 1
        union all
        select if(cast(company_root_cnpj as bigint) % 3 = 2, 'rows', 'rejects'), cast(count(*) as varchar)
        from raw_companies group by 1
    """,
    "history_repeated_run": "from history_2",
    "history_repeated_older_run": "from history_3",
    "publish_failed_repeat": "from raw_companies",
    "append_empty_repeat": stamped("raw_companies", 0),
    "ingest_overwrite": "from raw_companies_2",
    "ingest_append": "select * exclude (_loaded_at) from stored",
    "ingest_upsert": """
        from raw_companies_2 union all
        from raw_companies
        where company_root_cnpj not in (select company_root_cnpj from raw_companies_2)
    """,
    "current_state_two_releases": "from raw_companies_2",
    "ingest_job": " union all ".join(
        f"select '{s}' as source_name, '{raw_table(s)}' as target_table, "
        f"'overwrite' as load_strategy, count(*) as row_count from raw_{s}"
        for s in RAW
    ),
    "pipeline_fact": "from fct_active_companies",
    "pipeline_snapshot_two_releases": "from history_2",
    "pipeline_released_fact": f"""
        select *, date '{RELEASES[1]}' as _source_reference_date from fct_of_second_companies
    """,
    "pipeline_checks": f"""
        select * from ({' union all '.join(SUITE)})
            as suite(table_name, column_name, test_name, failures)
    """,
}

_NAME = re.compile(r"\b[a-z_0-9]+\b")


def _with_inputs(sql: str) -> str:
    """Put the tables a statement names, and those they name in turn, before it."""
    needed: dict[str, None] = {}

    def visit(statement: str) -> None:
        for name in _NAME.findall(statement):
            if name in TABLES and name not in needed:
                visit(TABLES[name])
                needed[name] = None

    visit(sql)
    if not needed:
        return sql
    tables = ", ".join(f"{name} as ({TABLES[name]})" for name in needed)
    return f"with {tables} {sql}"


ORACLE = {name: _with_inputs(sql) for name, sql in RESULTS.items()}
