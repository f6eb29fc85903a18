"""Ratio and label helpers with null-instead-of-error semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """num / den; null when either side is null or den is zero."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def growth(cur, prev) -> Column:
    """Year-over-year change (cur - prev) / prev computed in double from
    exact sums; null when a sum is null or prev is zero."""
    c, p = _c(cur).cast("double"), _c(prev).cast("double")
    return F.try_divide(c - p, p)


def pct_label(x) -> Column:
    """Percent text with two decimals, e.g. ``-1.88%``; null stays null."""
    return F.concat(F.format_number(_c(x) * 100, 2), F.lit("%"))
