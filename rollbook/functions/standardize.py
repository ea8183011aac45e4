"""Standardization of all-string register columns.

Every function takes a column name, or any SQL expression of a text, and returns a Column. The
rules are written as SQL text because a staging model has some sixty of them: one text is one
call to the JVM, where the same rule built from Column methods is a dozen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators that count as padding. Tabs and line ends do not.
SPACES = "".join(map(chr, (0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))

# Year, month and day digits; around them line ends and tabs, and outside those the padding.
# All other text matches the last branch, whose groups are empty.
_COMPACT_DATE = (
    rf"\A[{SPACES}]*[\t\n\x0B\f\r ]*"
    r"(\d{4})(0[1-9]|1[0-2])(0?[1-9]|[12]\d|3[01])"
    rf"[\t\n\x0B\f\r ]*[{SPACES}]*\z|\A[\s\S]*\z"
)


def _clean(value: str) -> str:
    """All padding but the plain space is outside ASCII, so ASCII text, which has as many bytes
    as characters, takes the much faster plain trim."""
    text = f"CAST({value} AS STRING)"
    return (
        f"nullif(CASE WHEN octet_length({text}) = char_length({text}) THEN trim({text}) "
        f"ELSE trim(BOTH '{SPACES}' FROM {text}) END, '')"
    )


def clean_text(value: str) -> Column:
    """Text without outer padding; empty text is NULL."""
    return F.expr(_clean(value))


def clean_upper(value: str) -> Column:
    return F.expr(f"upper({_clean(value)})")


def clean_lower(value: str) -> Column:
    return F.expr(f"lower({_clean(value)})")


def standardize_code(value: str, width: int) -> Column:
    """Code of exactly ``width`` characters: short codes get leading zeros, long ones are cut."""
    return F.expr(f"lpad({_clean(value)}, {width}, '0')")


def parse_compact_date(value: str) -> Column:
    """Date from year, month and day digits; the day may have one digit. Anything else is NULL.

    The pattern settles all but the length of the month, so filler values (``0``, ``00000000``)
    never reach the date parser, whose failure path is slow.
    """
    dashed = f"regexp_replace({value}, r'{_COMPACT_DATE}', '$1-$2-$3')"
    return F.expr(f"CASE WHEN length({value}) >= 7 THEN try_cast({dashed} AS DATE) END")


def yes_no_to_boolean(value: str) -> Column:
    """True for ``S`` in either case; all else, NULL included, is false."""
    return F.expr(f"coalesce(upper({_clean(value)}) = 'S', false)")


def parse_amount(value: str) -> Column:
    """decimal(18,2) from text with a decimal comma; NULL when it is not a number that fits."""
    return F.expr(f"try_cast(replace({_clean(value)}, ',', '.') AS DECIMAL(18,2))")


def establishment_key(root: str, order: str, digits: str) -> Column:
    """Full establishment number; NULL when any part is NULL."""
    return F.expr(f"concat({root}, {order}, {digits})")
