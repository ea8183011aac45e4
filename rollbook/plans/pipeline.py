"""The whole job: ingest, build, keep history, check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.operators.layout import CLUSTERING, RUN_ID, of_release, with_run_metadata
from rollbook.operators.quality import require_clean
from rollbook.plans.ingest import Run, Source, current_raw, ingest_all, select_sources
from rollbook.plans.intermediate import (
    active_company_base,
    company_profile,
    establishment_activity,
    partner_metrics,
)
from rollbook.plans.marts import FACT_COLUMNS, dim_cnaes, dim_companies, dim_establishments
from rollbook.plans.marts import fct_active_companies_from_parts as fct_active_companies
from rollbook.plans.rules import run_checks
from rollbook.plans.schemas import ROOT, intermediate_table, snapshot_table, staging_table
from rollbook.plans.staging import STAGING
from rollbook.plans.warehouse import Warehouse
from rollbook.session import concurrently

#: Every run's fact, partitioned by release; ``fct_active_companies`` is the current state of all.
RELEASED_FACT = "fct_active_companies_by_release"

SNAPSHOT_SUBJECT = "share_capital"
SNAPSHOT_COLUMNS = (
    "company_root_cnpj", "legal_name", "legal_nature_code", "share_capital",
    "company_size_code", "is_simples", "is_mei",
)
COMPARED = ("share_capital",)


def stage(
    warehouse: Warehouse, raw: Mapping[str, DataFrame], run: Run, materialize: bool = False
) -> dict[str, DataFrame]:
    """The staging models by source: views, or written tables for large sources."""
    staged = {source: model(raw[source]) for source, model in STAGING.items()}
    if materialize:
        return concurrently(
            {
                source: lambda s=source, d=df: warehouse.publish(
                    staging_table(s), d, run.run_id, moment=run.run_time
                )
                for source, df in staged.items()
            }
        )
    for source, df in staged.items():
        df.createOrReplaceTempView(staging_table(source))
    return staged


def build(
    warehouse: Warehouse, raw: Mapping[str, DataFrame], run: Run, materialize_staging: bool = False
) -> dict[str, DataFrame]:
    """Build and publish every model from the raw tables; returns them by short name."""

    def publish(name: str, df: DataFrame, **layout) -> DataFrame:
        return warehouse.publish(name, df, run.run_id, moment=run.run_time, **layout)

    def publish_intermediate(name: str, df: DataFrame) -> DataFrame:
        return publish(intermediate_table(name), df)

    def publish_mart(name: str, df: DataFrame, **layout) -> DataFrame:
        return publish(name, df, cluster_by=CLUSTERING[name], **layout)

    stg = stage(warehouse, raw, run, materialize_staging)
    tables = concurrently(
        {
            "company_profile": lambda: publish_intermediate(
                "company_profile", company_profile(stg["companies"], stg["simples"])
            ),
            "establishment_activity": lambda: publish_intermediate(
                "establishment_activity", establishment_activity(stg["establishments"])
            ),
            "partner_metrics": lambda: publish_intermediate(
                "partner_metrics", partner_metrics(stg["partners"])
            ),
            "dim_cnaes": lambda: publish_mart("dim_cnaes", dim_cnaes(stg["cnaes"])),
        }
    )
    profile, activity = tables["company_profile"], tables["establishment_activity"]
    tables |= concurrently(
        {
            "active_company_base": lambda: publish_intermediate(
                "active_company_base",
                active_company_base(activity, profile, tables["partner_metrics"]),
            ),
            "dim_companies": lambda: publish_mart("dim_companies", dim_companies(profile)),
            "dim_establishments": lambda: publish_mart(
                "dim_establishments", dim_establishments(activity, tables["dim_cnaes"])
            ),
        }
    )

    # Every run's fact stays under its release; the current fact takes it up slice by slice.
    fact = fct_active_companies(activity, profile, tables["partner_metrics"])
    stamped = with_run_metadata(fact, run.run_time, run.source_reference_date, run.run_id)
    released = warehouse.append(
        RELEASED_FACT,
        stamped,
        run.run_id,
        run.run_time,
        run.source_reference_date,
        sort_by=CLUSTERING["fct_active_companies"],
    )
    batch = released.filter(of_release(run.source_reference_date) & (F.col(RUN_ID) == run.run_id))
    fact = warehouse.merge(
        "fct_active_companies",
        batch.select(*FACT_COLUMNS),
        ROOT,
        run.run_id,
        run.run_time,
        sort_by=CLUSTERING["fct_active_companies"],
    )

    return {
        **{f"stg_{source}": df for source, df in stg.items()},
        **tables,
        "fct_active_companies": fact,
    }


def snapshot(warehouse: Warehouse, profile: DataFrame, run: Run) -> DataFrame:
    """Move the share-capital history on to this run's company profile."""
    return warehouse.advance_history(
        snapshot_table(SNAPSHOT_SUBJECT),
        profile.select(*SNAPSHOT_COLUMNS),
        ROOT,
        COMPARED,
        run.run_id,
        run.run_time,
        sort_by=CLUSTERING[SNAPSHOT_SUBJECT],
    )


def run_pipeline(
    warehouse: Warehouse,
    sources: Sequence[Source],
    run: Run,
    source_name: str | None = None,
    raise_on_failure: bool = True,
    materialize_staging: bool = False,
) -> dict[str, Any]:
    """Run the job. With ``source_name`` only that source is ingested and nothing is built,
    because one fresh source is not a complete set of raw tables."""
    ingested = ingest_all(warehouse, select_sources(sources, source_name), run)
    if source_name is not None:
        return {"ingestion": ingested, "tables": {}, "checks": None}
    raw = {source.name: current_raw(warehouse, source) for source in sources}
    tables = build(warehouse, raw, run, materialize_staging)
    tables["share_capital_snapshot"] = snapshot(warehouse, tables["company_profile"], run)
    checks = warehouse.publish(
        "data_quality_checks", run_checks(tables).coalesce(1), run.run_id, moment=run.run_time
    )
    if raise_on_failure:
        require_clean(checks)
    return {"ingestion": ingested, "tables": tables, "checks": checks}
