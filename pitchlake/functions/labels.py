"""Code -> label columns built from a mapping (unknown codes give NULL)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def label(col: str | Column, mapping: Mapping[object, str]) -> Column:
    """``CASE col WHEN k1 THEN v1 ... END``; codes outside the mapping are NULL.

    The mapping is a dict, so a code cannot be listed twice.
    """
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for code, text in mapping.items():
        cond = c == F.lit(code)
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr if expr is not None else F.lit(None).cast("string")


def resolve_sides(inning_half: str = "inning_topbot", home: str = "home_team",
                  away: str = "away_team") -> list[Column]:
    """``batting_team`` and ``fielding_team`` from the inning half.

    Top: the away team bats, the home team fields; Bot: the reverse; any
    other value gives NULL for both.
    """
    half = F.col(inning_half)
    batting = F.when(half == "Top", F.col(away)).when(half == "Bot", F.col(home)).alias("batting_team")
    fielding = F.when(half == "Top", F.col(home)).when(half == "Bot", F.col(away)).alias("fielding_team")
    return [batting, fielding]
