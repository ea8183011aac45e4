"""Plans and results when one company or one code holds a third of all rows."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollbook.operators import quality
from rollbook.operators.upsert import current_state
from rollbook.plans import intermediate, marts
from rollbook.plans.schemas import ROOT
from rollbook.session import written

HOT, ROWS = "00000000", 30_000

SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_skew(spark):
    """Thresholds at which the small fixture counts as skewed and nothing is broadcast."""
    before = {name: spark.conf.get(name, None) for name in SMALL_SKEW}
    for name, value in SMALL_SKEW.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value in (None, "<undefined>"):
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Activity, profile and partners with a third of the establishments on one company."""
    folder = tmp_path_factory.mktemp("hot")
    number = F.col("id")
    root = F.when(number % 3 == 0, HOT).otherwise(F.lpad((number % 997).cast("string"), 8, "0"))
    activity = spark.range(0, ROWS, 1, 12).select(
        F.concat(root, F.lpad(number.cast("string"), 6, "0")).alias("full_cnpj"),
        root.alias(ROOT),
        F.lit("0001").alias("branch_order"),
        F.when(number % 50 == 7, "1").otherwise("2").alias("branch_type_code"),
        (number % 50 == 7).alias("is_headquarters"),
        (number % 50 != 7).alias("is_branch"),
        F.concat(F.lit("name "), number.cast("string")).alias("trade_name"),
        F.lit("02").alias("registration_status_code"),
        (number % 4 != 0).alias("is_active"),
        F.date_add(F.lit("2020-01-01").cast("date"), (number % 900).cast("int")).alias(
            "registration_status_date"
        ),
        F.date_add(F.lit("2010-01-01").cast("date"), (number % 700).cast("int")).alias(
            "activity_start_date"
        ),
        F.when(number % 3 != 1, "0000001").alias("primary_cnae_code"),
        F.lit("SP").alias("state"),
        F.lpad((number % 10).cast("string"), 4, "0").alias("municipality_code"),
    )
    companies = spark.range(0, 997, 1, 4).select(
        F.lpad(number.cast("string"), 8, "0").alias(ROOT),
        F.concat(F.lit("company "), number.cast("string")).alias("legal_name"),
        F.lit("2062").alias("legal_nature_code"),
        F.lit("49").alias("responsible_qualification_code"),
        (number * 10).cast("decimal(18,2)").alias("share_capital"),
        F.lit("01").alias("company_size_code"),
        F.lit(None).cast("string").alias("responsible_federative_entity"),
    )
    simples = spark.range(0, 3000, 1, 4).select(
        F.when(number % 3 == 0, HOT).otherwise(F.lpad((number % 500).cast("string"), 8, "0")).alias(ROOT),
        F.when(number % 2 == 0, "S").otherwise("N").alias("simples_option"),
        F.lit("N").alias("mei_option"),
        *(
            F.lit("2020-01-01").cast("date").alias(f"{kind}_{what}_date")
            for kind in ("simples", "mei")
            for what in ("option", "exclusion")
        ),
    )
    partners = spark.range(0, ROWS, 1, 12).select(
        root.alias(ROOT),
        (number % 3 + 1).cast("string").alias("partner_identifier_code"),
        F.lit("2015-05-05").cast("date").alias("partnership_start_date"),
    )
    frames = {"activity": activity, "companies": companies, "simples": simples, "partners": partners}
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in frames}


def plan_after(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def company_tables(hot):
    """Profile and partner metrics as the job has them: written tables."""
    profile = intermediate.company_profile(hot["companies"], hot["simples"])
    return written(profile, "profile"), written(intermediate.partner_metrics(hot["partners"]), "metrics")


def test_hot_company_is_split_in_the_base_join(spark, small_skew, hot):
    base = intermediate.active_company_base(hot["activity"], *company_tables(hot))
    result = base.select(ROOT, "full_cnpj", "legal_name", "is_simples", "partner_count")
    found = result.collect()
    assert plan_after(result).count("SortMergeJoin(skew=true)") >= 2
    activity = hot["activity"].filter("is_active").collect()
    names = {r[ROOT]: r.legal_name for r in hot["companies"].collect()}
    options = {}
    for r in hot["simples"].collect():
        options[r[ROOT]] = max(options.get(r[ROOT], "N"), r.simples_option)
    counts = Counter(r[ROOT] for r in hot["partners"].collect())
    expected = {
        (r[ROOT], r.full_cnpj, names.get(r[ROOT]), options.get(r[ROOT]) == "S", counts[r[ROOT]])
        for r in activity
    }
    assert {tuple(r) for r in found} == expected and len(found) == len(activity)


def test_hot_code_is_split_in_the_activity_join(spark, small_skew, hot):
    cnaes = spark.range(0, 200).select(
        F.lpad(F.col("id").cast("string"), 7, "0").alias("cnae_code"),
        F.concat(F.lit("activity "), F.col("id").cast("string")).alias("cnae_description"),
    )
    activity = hot["activity"].select(
        "full_cnpj", "branch_type_code", "registration_status_code", "primary_cnae_code",
        F.lit(None).cast("string").alias("phone_1"), F.lit("1").alias("phone_2"),
        F.lit(None).cast("string").alias("email"),
    )
    result = marts.dim_establishments(activity, written(cnaes, "cnaes"))
    described = result.filter(F.col("primary_cnae_description") == "activity 1")
    assert result.count() == ROWS and described.count() == ROWS * 2 // 3
    result.collect()
    assert "skew=true" in plan_after(result)


def brute_fact(hot):
    names = {r[ROOT]: r.legal_name for r in hot["companies"].collect()}
    counts = Counter(r[ROOT] for r in hot["partners"].collect())
    companies: dict = {}
    for r in hot["activity"].filter("is_active").collect():
        companies.setdefault(r[ROOT], []).append(r)
    expected = set()
    for root, rows in companies.items():
        best = min(rows, key=lambda r: (not r.is_headquarters, r.full_cnpj))
        expected.add(
            (
                root, best.full_cnpj, best.branch_type_code, names.get(root), len(rows),
                sum(r.is_headquarters for r in rows), sum(r.is_branch for r in rows), counts[root],
                min(r.activity_start_date for r in rows),
                max(r.registration_status_date for r in rows),
            )
        )
    return expected


FACT = (
    ROOT, "representative_full_cnpj", "representative_branch_type_code", "legal_name",
    "active_establishment_count", "active_headquarters_count", "active_branch_count",
    "partner_count", "first_activity_start_date", "latest_registration_status_date",
)


@pytest.mark.parametrize("copies", [1, 3])
def test_both_facts_equal_brute_force(spark, small_skew, hot, copies):
    """Also when every establishment is there several times: counts are of distinct ones."""
    activity = hot["activity"]
    for _ in range(copies - 1):
        activity = activity.unionByName(hot["activity"])
    profile, metrics = company_tables(hot)
    base = intermediate.active_company_base(activity, profile, metrics)
    expected = brute_fact(hot)
    for fact in (
        marts.fct_active_companies(base),
        marts.fct_active_companies_from_parts(activity, profile, metrics),
    ):
        found = fact.select(*FACT).collect()
        assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_aggregations_reduce_before_they_shuffle(hot):
    """Below the first exchange there is a partial aggregation or a partial rank filter."""
    frames = {
        "partners": intermediate.partner_metrics(hot["partners"]),
        "simples": intermediate.simples_by_company(hot["simples"]),
        "repeated": quality.repeated_values(hot["activity"], ROOT),
        "representative": marts.representative_establishments(
            hot["activity"].filter("is_active")
        ),
        "current": current_state(hot["simples"], [ROOT], ["simples_option_date"]),
    }
    for name, df in frames.items():
        below = plan_after(df).split("Exchange hashpartitioning")[-1]
        assert "partial_" in below or "WindowGroupLimit" in below, name


def test_hot_company_does_not_reach_one_task_as_rows(spark, hot):
    """The fact's first exchange, as planned, spreads the hot company's rows; after the first
    aggregation the second exchange gets one partial row of it per task."""
    fact = marts.fct_active_companies_from_parts(
        hot["activity"],
        intermediate.company_profile(hot["companies"], hot["simples"]),
        intermediate.partner_metrics(hot["partners"]),
    )
    plan = plan_after(fact)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    by_establishment = [line for line in exchanges if "full_cnpj" in line]
    assert by_establishment, plan
    deepest = max(by_establishment, key=lambda line: line.index("Exchange"))
    keys = [k.split("#")[0].strip() for k in deepest.split("hashpartitioning(")[1].split(")")[0].split(",")]
    partitioned_by = [k for k in keys if not k.isdigit()]
    assert partitioned_by[:2] == [ROOT, "full_cnpj"]
    sizes = (
        hot["activity"].filter("is_active").repartition(8, *partitioned_by[:2])
        .filter(F.col(ROOT) == HOT).groupBy(F.spark_partition_id()).count().collect()
    )
    assert len(sizes) == 8
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_columns_are_pruned_and_filters_pushed(hot):
    active = intermediate.active_company_base(
        hot["activity"],
        intermediate.company_profile(hot["companies"], hot["simples"]),
        intermediate.partner_metrics(hot["partners"]),
    ).select("full_cnpj", "state")
    plan = plan_after(active)
    assert "PushedFilters: [IsNotNull(is_active), EqualTo(is_active,true)]" in plan
    assert "trade_name" not in plan
