"""Ratios and percentages that never fail on an empty input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column, scale: int = 2) -> Column:
    """round(num * 100 / den, scale); NULL on an empty denominator."""
    return F.round(F.try_divide(num.cast("double") * F.lit(100.0), den.cast("double")), scale)
