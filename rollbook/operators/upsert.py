"""Keyed incremental loads on tables that know no MERGE."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    forms: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Replace the rows of ``target`` whose key is in ``batch``; keep the others.

    ``forms`` gives the form in which a key column is compared, where that is not its own. A NULL
    key equals nothing, so rows without a key stay; see ``with_known_keys``. The result has the columns of the batch: a column new in the batch is NULL on kept rows, a
    column gone from the batch is dropped. Keys the batch does not hold stay. With no target
    the batch is the result.
    """
    if not keys:
        raise ValueError("an upsert needs at least one key column")
    if target is None:
        return batch
    compared = {f"_key_{i}": (forms or {}).get(k, F.col(k)) for i, k in enumerate(keys)}
    fresh = batch.select(*(form.alias(f"{name}_new") for name, form in compared.items()))
    same = reduce(Column.__and__, [F.col(name) == F.col(f"{name}_new") for name in compared])
    kept = target.withColumns(compared).join(fresh, same, "left_anti").drop(*compared)
    return kept.unionByName(batch, allowMissingColumns=True).select(*batch.columns)


def with_known_keys(rows: DataFrame, keys: Sequence[str], forms: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows whose key has no NULL. No later batch could replace the others, so a table that is
    upserted again and again keeps only those its last batch brought."""
    return rows.filter(reduce(Column.__and__, [(forms or {}).get(k, F.col(k)).isNotNull() for k in keys]))


def one_per_key(rows: DataFrame, keys: Sequence[str], forms: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per key, the first by its other columns; rows whose key has a NULL all stay."""
    compared = [(forms or {}).get(k, F.col(k)) for k in keys]
    known = reduce(Column.__and__, [form.isNotNull() for form in compared])
    order = Window.partitionBy(*compared).orderBy(*(F.col(c).asc_nulls_last() for c in rows.columns))
    ranked = rows.filter(known).withColumn("_rank", F.row_number().over(order))
    first = ranked.filter("_rank = 1").drop("_rank")
    return first.unionByName(rows.filter(~known))


def current_state(
    rows: DataFrame, keys: Sequence[str], newest_first: Sequence[str]
) -> DataFrame:
    """The newest row per key of an append-only history.

    Rows that tie on all of ``newest_first`` are ordered by their other columns, so the choice
    does not depend on the run. The rank filter makes each task keep one row per key before
    the shuffle, so a key with very many versions is no hot spot.
    """
    others = [c for c in rows.columns if c not in keys and c not in newest_first]
    order = Window.partitionBy(*keys).orderBy(
        *(F.col(c).desc_nulls_last() for c in newest_first),
        *(F.col(c).asc_nulls_last() for c in others),
    )
    return (
        rows.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
    )
