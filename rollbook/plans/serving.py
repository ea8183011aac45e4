"""The questions the finished tables answer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.operators.history import VALID_FROM, VALID_TO, history_of
from rollbook.operators.layout import of_release
from rollbook.plans.schemas import ROOT


def active_by_state_and_activity(
    fact: DataFrame, state: str | None = None, release: str | None = None
) -> DataFrame:
    """Active companies by state and main activity, of one state or release if given.

    With a release ``fact`` is the table of every release's fact, of which one partition is read.
    """
    if release is not None:
        fact = fact.filter(of_release(release))
    if state is not None:
        fact = fact.filter(F.col("state") == state)
    return fact.groupBy("state", "primary_cnae_code").agg(
        F.sum("active_company_count").alias("active_companies")
    )


def company_lookup(companies: DataFrame, root: str) -> DataFrame:
    return companies.filter(F.col(ROOT) == root)


def share_capital_history(history: DataFrame, root: str) -> DataFrame:
    return history_of(history, ROOT, root).select(ROOT, "share_capital", VALID_FROM, VALID_TO)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows, from the file footers where possible."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def preview(table: DataFrame, rows: int = 10) -> DataFrame:
    return table.limit(rows)
