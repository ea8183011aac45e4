"""Type 2 history: validity intervals per key, compared on chosen columns.

The history is two frames, because their life differs at scale: closed versions never change
and only grow, open versions are one row per key and are all that a run has to read.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION_ID, UPDATED_AT, VALID_FROM, VALID_TO = (
    "dbt_scd_id",
    "dbt_updated_at",
    "dbt_valid_from",
    "dbt_valid_to",
)
VERSION_COLUMNS = (VERSION_ID, UPDATED_AT, VALID_FROM, VALID_TO)


def _moment(run_time: datetime) -> Column:
    return F.lit(run_time.isoformat(" ")).cast("timestamp_ntz")


def _version_columns(key: Column, run_time: datetime) -> list[Column]:
    now = _moment(run_time)
    text = run_time.isoformat(" ")
    return [
        F.md5(F.concat_ws("|", key, F.lit(text))).alias(VERSION_ID),
        now.alias(UPDATED_AT),
        now.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    ]


def first_versions(source: DataFrame, key: str, run_time: datetime) -> DataFrame:
    """One open version per row of the source."""
    return source.select("*", *_version_columns(F.col(key), run_time))


def next_versions(
    open_versions: DataFrame,
    source: DataFrame,
    key: str,
    compared: Sequence[str],
    run_time: datetime,
) -> DataFrame:
    """What a run makes of the open versions: closed, unchanged and new ones, in one join.

    A key gone from the source is closed. A key whose compared columns differ (NULL equals
    NULL) is closed and opened anew. A difference in any other column opens nothing and the
    old values stay. A key with no open version, new or back again, is opened.
    """
    was, now = open_versions.alias("was"), source.alias("now")
    old_key, new_key = F.col(f"was.{key}"), F.col(f"now.{key}")
    same = [F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}")) for c in compared]
    changed = ~reduce(Column.__and__, same)
    columns = source.columns

    carried = [F.col(f"was.{c}").alias(c) for c in (*columns, *VERSION_COLUMNS[:-1])]
    ends = F.when(new_key.isNull() | changed, _moment(run_time))
    old = F.struct(*carried, ends.alias(VALID_TO))
    new = F.struct(
        *(F.col(f"now.{c}").alias(c) for c in columns), *_version_columns(new_key, run_time)
    )
    versions = (
        F.when(old_key.isNull(), F.array(new))
        .when(new_key.isNotNull() & changed, F.array(old, new))
        .otherwise(F.array(old))
    )
    return was.join(now, old_key == new_key, "full_outer").select(F.inline(versions))


def is_open() -> Column:
    return F.col(VALID_TO).isNull()


def advance(
    history: DataFrame,
    source: DataFrame,
    key: str,
    compared: Sequence[str],
    run_time: datetime,
) -> DataFrame:
    """The whole history after a run: closed versions as they were, open ones moved on."""
    moved = next_versions(history.filter(is_open()), source, key, compared, run_time)
    return history.filter(~is_open()).unionByName(moved)


def history_of(history: DataFrame, key: str, value: str) -> DataFrame:
    """The versions of one key in the order they became valid."""
    return history.filter(F.col(key) == value).orderBy(F.col(VALID_FROM).asc_nulls_last())
