"""Ratios over aggregated measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(20,0)"


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` to four decimals, half away from zero; NULL for an empty whole.

    The division runs in decimal so that rounding sees exact ties; the result is a double.
    """
    share = F.try_divide(part.cast(_WIDE) * 100, whole.cast(_WIDE))
    return F.round(share, 4).cast("double")


def average(total: Column, count: Column) -> Column:
    """Mean from an exact decimal sum, so the result does not depend on row order."""
    return F.try_divide(total.cast("double"), count.cast("double"))
