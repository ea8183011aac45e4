"""Flags, ranges, labels and measures derived from standardized columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code domains of the register and their labels.
COMPANY_SIZE_LABELS = {
    "00": "not_informed",
    "01": "micro_company",
    "03": "small_company",
    "05": "other",
}
BRANCH_TYPE_LABELS = {"1": "headquarters", "2": "branch"}
REGISTRATION_STATUS_LABELS = {
    "01": "null",  # the text, not a missing value
    "02": "active",
    "03": "suspended",
    "04": "unsuitable",
    "08": "closed",
}
UNKNOWN = "unknown"

# Upper bounds (exclusive) of the share-capital ranges.
CAPITAL_RANGES = ((10_000, "up_to_10k"), (100_000, "10k_to_100k"), (1_000_000, "100k_to_1m"))
TOP_CAPITAL_RANGE = "over_1m"

HEADQUARTERS, BRANCH, ACTIVE = "1", "2", "02"

# Prefix lengths of the activity hierarchy.
ACTIVITY_LEVELS = {"division": 2, "group": 3, "class": 5, "subclass": 7}


def label_of(code: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code; codes outside the mapping, NULL included, are ``unknown``."""
    first, *rest = labels.items()
    chain = F.when(code == first[0], first[1])
    for known, label in rest:
        chain = chain.when(code == known, label)
    return chain.otherwise(UNKNOWN)


def capital_range(amount: Column) -> Column:
    """Range label of a share capital; a NULL capital falls through to the top range."""
    branches = [(amount < bound, label) for bound, label in CAPITAL_RANGES]
    chain = reduce(lambda c, b: c.when(*b), branches[1:], F.when(*branches[0]))
    return chain.otherwise(TOP_CAPITAL_RANGE)


def equals_flag(column: Column, value: str) -> Column:
    """Equality that is false, never NULL, on a missing value."""
    return F.coalesce(column == value, F.lit(False))


def present_flag(*columns: Column) -> Column:
    """True when at least one of the columns holds a value."""
    return reduce(Column.__or__, [c.isNotNull() for c in columns])


def zero_if_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def false_last(flag: Column) -> Column:
    """Sort key that puts true first and false or NULL after it."""
    return F.when(flag, 0).otherwise(1)


def activity_prefix(code: Column, level: str) -> Column:
    return F.substring(code, 1, ACTIVITY_LEVELS[level])


def activity_label(code: Column, description: Column) -> Column:
    """``code - description``; NULL when the description is missing."""
    return F.concat(code, F.lit(" - "), description)


def any_true(flag: Column) -> Column:
    """Aggregate: whether any row has the flag; NULL counts as false."""
    return F.coalesce(F.bool_or(flag), F.lit(False))
