"""The models over the given tables of one folder, built lazily."""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import (
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
from rollbook.operators.layout import with_run_metadata
from rollbook.plans import intermediate, marts
from rollbook.plans.pipeline import SNAPSHOT_COLUMNS
from rollbook.plans.staging import STAGING
from rollbook.session import all_written, tune


class Register:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        #: Folders of the archives written so far, by source and release.
        self.archives: dict[tuple[str, int], str] = {}

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, source: str) -> DataFrame:
        table = GIVEN[source]
        return self.spark.sql(RAW[source], **{table: self.given(table)})

    def stg(self, source: str) -> DataFrame:
        return STAGING[source](self.raw(source))

    @cached_property
    def profile(self) -> DataFrame:
        return intermediate.company_profile(self.stg("companies"), self.stg("simples"))

    @cached_property
    def activity(self) -> DataFrame:
        return intermediate.establishment_activity(self.stg("establishments"))

    @cached_property
    def partners(self) -> DataFrame:
        return intermediate.partner_metrics(self.stg("partners"))

    @cached_property
    def company_tables(self) -> tuple[DataFrame, DataFrame]:
        """Profile and partner metrics, written as the job writes them."""
        tables = all_written({"profile": self.profile, "partner_metrics": self.partners})
        return tables["profile"], tables["partner_metrics"]

    @cached_property
    def base(self) -> DataFrame:
        return intermediate.active_company_base(self.activity, *self.company_tables)

    @cached_property
    def cnaes(self) -> DataFrame:
        return marts.dim_cnaes(self.stg("cnaes"))

    @cached_property
    def companies(self) -> DataFrame:
        return marts.dim_companies(self.profile)

    @cached_property
    def establishments(self) -> DataFrame:
        return marts.dim_establishments(self.activity, self.cnaes)

    @cached_property
    def fact(self) -> DataFrame:
        return marts.fct_active_companies_from_parts(self.activity, self.profile, self.partners)

    # Later releases.

    def raw_companies(self, release: int) -> DataFrame:
        first = self.raw("companies")
        if release == 0:
            return first
        second = self.spark.sql(SECOND_COMPANIES, companies=first)
        if release == 1:
            return second
        return self.spark.sql(THIRD_COMPANIES, companies=first, second=second)

    def stamped_companies(self, release: int) -> DataFrame:
        return with_run_metadata(
            self.raw_companies(release),
            datetime.fromisoformat(LOADED_AT[release]),
            RELEASES[release],
            RUN_IDS[release],
        )

    def capital_source(self, release: int) -> DataFrame:
        companies = STAGING["companies"](self.raw_companies(release))
        profile = intermediate.company_profile(companies, self.stg("simples"))
        return profile.select(*SNAPSHOT_COLUMNS)

    @cached_property
    def second_activity(self) -> DataFrame:
        raw = self.raw("establishments").withColumns(
            {"registration_status_code": F.expr(SECOND_STATUS), "state": F.expr(SECOND_STATE)}
        )
        return intermediate.establishment_activity(STAGING["establishments"](raw))

    @cached_property
    def second_fact(self) -> DataFrame:
        return marts.fct_active_companies_from_parts(
            self.second_activity, self.profile, self.partners
        )


def run_time(release: int) -> datetime:
    return datetime.fromisoformat(RELEASES[release])
