"""Unit conversion of measures (mph -> km/h, ft -> cm, ft -> m)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake.schemas import UNIT_SPECS, UnitSpec


def converted(spec: UnitSpec, digits: int = 2) -> Column:
    """``round(double(source) * factor, digits) AS output``."""
    return F.round(F.col(spec.source).cast("double") * F.lit(spec.factor), digits).alias(spec.output)


def convert_units(specs: Iterable[UnitSpec] = UNIT_SPECS, digits: int = 2) -> list[Column]:
    """Converted measure columns, one per spec, for use in a ``select``."""
    return [converted(s, digits) for s in specs]
