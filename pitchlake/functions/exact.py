"""Exact rounded averages of two-decimal measures.

``round(avg(x), 2)`` over doubles depends on summation order and on how the
binary average is rounded.  Silver measures already carry two decimals, so
the average is computed exactly from integer hundredths: partial sums are
plain longs (cheap, codegen'd, combinable map-side) and only the final
quotient is rounded, half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hundredths(col: str | Column, scale: int = 2) -> Column:
    """The value as an integer number of 10^-scale units (exact for values with `scale` decimals)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double") * F.lit(10 ** scale)).cast("long")


def avg_parts(col: str | Column, name: str, scale: int = 2) -> list[Column]:
    """Aggregate columns ``{name}__s`` (sum of units) and ``{name}__n`` (non-NULL count)."""
    c = F.col(col) if isinstance(col, str) else col
    return [F.sum(hundredths(c, scale)).alias(f"{name}__s"), F.count(c).alias(f"{name}__n")]


def avg_from_parts(name: str, scale: int = 2) -> Column:
    """Round-half-away-from-zero of ``sum/n`` to `scale` decimals, as double; NULL when n = 0."""
    s, n = f"`{name}__s`", f"`{name}__n`"
    q = F.expr(f"CAST(sign({s}) AS BIGINT) * ((2 * abs({s}) + {n}) div (2 * {n}))")
    return F.when(F.col(f"{name}__n") > 0, q.cast("double") / F.lit(float(10 ** scale))).alias(name)
