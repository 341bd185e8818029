"""Text, number-format and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a full whitespace strip removes (blank-only trims do not).
ALL_WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(ALL_WHITESPACE))


def normalised_category(category: Column) -> Column:
    """Warehouse form: lower case, blanks trimmed (tabs and the like stay)."""
    return F.lower(F.trim(category))


def full_name(first: Column, last: Column) -> Column:
    """NULL when either part is NULL."""
    return F.trim(F.concat(first, F.lit(" "), last))


def whole_number(value: Column) -> Column:
    """Nearest integer as text, ties to even."""
    return F.rint(value).try_cast("bigint").cast("string")


def two_decimals(value: Column) -> Column:
    """Two decimals as text, ties to even."""
    exact = F.bround(value, 2)
    return F.coalesce(
        exact.try_cast("decimal(38,2)").cast("string"), F.format_string("%.2f", exact)
    )


def iso_utc(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def row_as_json(*columns: str | Column) -> Column:
    """JSON text of the columns; NULL fields are written, not dropped."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
