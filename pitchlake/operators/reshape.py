"""Side stacks: one row per game -> one row per side, in a single scan.

A ``UNION ALL`` of two projections reads the input twice; here each input
row emits its side rows through ``inline(array(struct(...), ...))``, one
scan and no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(df: DataFrame, rows: Sequence[Mapping[str, Column]], keep: Sequence[str] = ()) -> DataFrame:
    """Emit one output row per mapping for every input row.

    Each mapping gives the output columns (same names, same order in every
    mapping); ``keep`` columns are copied to every emitted row.
    """
    names = list(rows[0].keys())
    for r in rows:
        if list(r.keys()) != names:
            raise ValueError("every stacked row needs the same columns in the same order")
    structs = [F.struct(*[c.alias(n) for n, c in r.items()]) for r in rows]
    return df.select(*[F.col(k) for k in keep], F.inline(F.array(*structs)))


def stack_sides(df: DataFrame, sides: Mapping[str, str], measures: Mapping[str, str],
                out_key: str = "team", keep: Sequence[str] = ()) -> DataFrame:
    """Two (or more) rows per input row, one per side, with common column names.

    ``sides`` maps side prefix -> key column (``{"home": "home_team", ...}``);
    ``measures`` maps output name -> column suffix, read as ``<prefix>_<suffix>``.
    """
    rows = [{out_key: F.col(key_col), **{m: F.col(f"{prefix}_{suffix}") for m, suffix in measures.items()}}
            for prefix, key_col in sides.items()]
    return stack(df, rows, keep)


def side_difference(measure: str, sides: Sequence[str] = ("home", "away")) -> Column:
    """``<first side>_<measure> - <second side>_<measure>``."""
    first, second = (F.col(f"{side}_{measure}") for side in sides)
    return first - second


def of_named_side(named_by: str, measure: str, sides: Mapping[str, str]) -> Column:
    """The measure of the side whose key equals the column ``named_by``.

    ``sides`` maps side prefix -> key column.  The last side also stands for a
    name that is no side's key (a tie) or NULL.
    """
    *others, last = sides
    out = F.col(f"{last}_{measure}")
    for side in reversed(others):
        out = F.when(F.col(named_by) == F.col(sides[side]), F.col(f"{side}_{measure}")).otherwise(out)
    return out
