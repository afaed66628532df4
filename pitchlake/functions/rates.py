"""Derived rates with zero guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_rate(num: str | Column, den: str | Column, digits: int = 5) -> Column:
    """``round(num / den, digits)``, 0 when den is not positive."""
    return F.round(F.when(_c(den) > 0, _c(num) / _c(den)).otherwise(F.lit(0.0)), digits)


def percent(part: str | Column, total: str | Column, digits: int = 2) -> Column:
    """``round(part / total * 100, digits)``; NULL when total is 0 or NULL."""
    return F.round(F.try_divide(_c(part), _c(total)) * F.lit(100), digits)
