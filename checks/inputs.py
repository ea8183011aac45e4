"""The given tables projected onto the raw register tables, and their later releases.

Every statement is valid in Spark SQL and in DuckDB; the names in braces are its inputs. All
rows of the given tables take part. Edge cases are planted on purpose: blanks, padding, lower
case, invalid dates and amounts, unknown codes, missing sizes, orphan activity codes, many rows
per company, partners without a company and companies without partners.
"""

from __future__ import annotations

RAW = {
    "cnaes": """
        select cast(p_partkey as string) as cnae_code,
               '  ' || p_name || ' ' as cnae_description
        from {part}
    """,
    "companies": """
        select cast(c_custkey as string) as company_root_cnpj,
               c_name || '  ' as legal_name,
               cast(100 + c_nationkey as string) as legal_nature_code,
               cast(c_custkey % 60 as string) as responsible_qualification_code,
               case when c_custkey % 97 = 0 then 'n/a'
                    else replace(cast(cast(abs(c_acctbal) as decimal(18,2))
                         * (case c_custkey % 4 when 0 then 1 when 1 then 10 when 2 then 100
                            else 1000 end) as string), '.', ',')
               end as share_capital,
               case c_mktsegment when 'AUTOMOBILE' then '1' when 'BUILDING' then '3'
                    when 'HOUSEHOLD' then '5' when 'MACHINERY' then '0' else ''
               end as company_size_code,
               case when c_custkey % 11 = 0 then c_mktsegment else ''
               end as responsible_federative_entity
        from {customer}
    """,
    "simples": """
        select cast(user_id as string) as company_root_cnpj,
               case when event_type = 'purchase' and user_id % 3 = 0 then 'S'
                    when event_type = 'error' then '' else 'N' end as simples_option,
               replace(cast(cast(ts as date) as string), '-', '') as simples_option_date,
               case when event_id % 10 = 0 then replace(cast(cast(ts as date) as string), '-', '')
                    else '00000000' end as simples_exclusion_date,
               case when event_id % 7 = 0 and user_id % 2 = 0 then ' S ' else 'N'
               end as mei_option,
               case when event_id % 7 = 0 and user_id % 2 = 0
                    then replace(cast(cast(ts as date) as string), '-', '') else ''
               end as mei_option_date,
               '0' as mei_exclusion_date
        from {events}
    """,
    "establishments": """
        select cast(o_custkey as string) as company_root_cnpj,
               cast(cast((o_orderkey - o_orderkey % 100) / 100 as bigint) as string)
                   as branch_order,
               cast(o_orderkey % 100 as string) as check_digits,
               case when o_orderkey % 5 = 0 then '1' else '2' end as branch_type_code,
               ' ' || o_orderpriority as trade_name,
               case o_orderstatus when 'O' then '2' when 'P' then '4'
                    else case when o_orderkey % 2 = 0 then '8' when o_orderkey % 7 = 0 then '1'
                              when o_orderkey % 11 = 0 then '9' else '3' end
               end as registration_status_code,
               case when o_orderkey % 50 = 0 then '00000000'
                    else replace(cast(cast(o_orderdate as date) as string), '-', '')
               end as registration_status_date,
               cast(o_orderkey % 3 as string) as registration_status_reason_code,
               case when o_orderkey % 20 = 0 then 'Lisboa' else '' end as foreign_city_name,
               case when o_orderkey % 20 = 0 then '15' else '' end as country_code,
               case when o_orderkey % 77 = 0 then '20240230'
                    else replace(cast(cast(o_orderdate as date) as string), '-', '')
               end as activity_start_date,
               case when o_orderkey % 401 = 0 then '9999999'
                    else cast(o_orderkey % 200 as string) end as primary_cnae_code,
               cast(o_orderkey % 200 as string) || ',' || cast(o_custkey % 200 as string)
                   as secondary_cnae_codes,
               'RUA' as street_type,
               ' Rua ' || cast(o_custkey as string) as street_name,
               cast(o_orderkey % 1000 as string) as address_number,
               '' as address_complement,
               'Centro' as district,
               cast(1000000 + o_orderkey as string) as postal_code,
               case o_orderkey % 3 when 0 then 'sp' when 1 then ' rj ' else '' end as state,
               cast(o_orderkey % 5000 as string) as municipality_code,
               case when o_orderkey % 4 = 0 then '11' else '' end as area_code_1,
               case when o_orderkey % 4 = 0 then cast(o_orderkey as string) else ''
               end as phone_1,
               '' as area_code_2,
               case when o_orderkey % 6 = 0 then cast(o_orderkey as string) else ' '
               end as phone_2,
               '' as fax_area_code,
               '' as fax_number,
               case when o_orderkey % 3 = 0 then 'User' || cast(o_custkey as string) || '@X.COM'
                    else ' ' end as email,
               case when o_orderkey % 500 = 0 then 'RECUPERACAO' else '' end as special_status,
               case when o_orderkey % 500 = 0 then '20200131' else '0' end as special_status_date
        from {orders}
    """,
    "partners": """
        select cast(l_partkey + case when l_partkey % 17 = 0 then 90000000 else 0 end as string)
                   as company_root_cnpj,
               case l_returnflag when 'A' then '1' when 'N' then '2' else '3'
               end as partner_identifier_code,
               'Partner ' || cast(l_suppkey as string) as partner_name,
               '***' || cast(l_orderkey as string) || '**' as partner_document,
               cast(l_linenumber as string) as partner_qualification_code,
               replace(cast(cast(l_shipdate as date) as string), '-', '')
                   as partnership_start_date,
               '' as country_code,
               '' as legal_representative_document,
               '' as legal_representative_name,
               '0' as legal_representative_qualification_code,
               cast(l_linenumber % 9 as string) as partner_age_range_code
        from {lineitem}
    """,
}

GIVEN = {
    "cnaes": "part",
    "companies": "customer",
    "simples": "events",
    "establishments": "orders",
    "partners": "lineitem",
}

# The second release of the companies: keys that are gone (% 13), NULL capitals that are filled
# and filled ones that turn invalid (% 97), raised capitals (% 10 = 0), other names (% 10 = 1)
# and new keys.
SECOND_COMPANIES = """
    select company_root_cnpj,
           case when cast(company_root_cnpj as bigint) % 10 = 1 then 'Nova ' || legal_name
                else legal_name end as legal_name,
           legal_nature_code,
           responsible_qualification_code,
           case when cast(company_root_cnpj as bigint) % 97 = 0 then '5,00'
                when cast(company_root_cnpj as bigint) % 97 = 1 then 'n/a'
                when cast(company_root_cnpj as bigint) % 10 = 0
                then replace(cast(try_cast(replace(share_capital, ',', '.') as decimal(18,2))
                                  + 1.00 as string), '.', ',')
                else share_capital end as share_capital,
           company_size_code,
           responsible_federative_entity
    from {companies}
    where cast(company_root_cnpj as bigint) % 13 <> 0
    union all
    select cast(cast(company_root_cnpj as bigint) + 10000000 as string),
           legal_name, legal_nature_code, responsible_qualification_code, share_capital,
           company_size_code, responsible_federative_entity
    from {companies}
    where cast(company_root_cnpj as bigint) % 50 = 0
"""

# The third release: the second one, with the keys that were gone back again.
THIRD_COMPANIES = """
    select * from {second}
    union all
    select * from {companies} where cast(company_root_cnpj as bigint) % 13 = 0
"""

# The second release of the establishments: some companies close for good, others move.
SECOND_STATUS = "case when cast(company_root_cnpj as bigint) % 9 = 0 then '8' else registration_status_code end"
SECOND_STATE = "case when cast(company_root_cnpj as bigint) % 10 = 0 then 'mg' else state end"

RELEASES = ("2026-05-10", "2026-06-10", "2026-07-10")
RUN_IDS = ("r20260510", "r20260610", "r20260710")
LOADED_AT = ("2026-05-12 06:00:00", "2026-06-25 06:00:00", "2026-07-12 06:00:00")
AS_OF = "2026-07-01"
