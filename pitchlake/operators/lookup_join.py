"""Dimension lookup: replace id columns of a fact table by names from a dimension.

A plain left join per role on two columns, the id and whether there is one.
Spark chooses the strategy from the size of the dimension (a small one is
broadcast).  NULL ids match nothing: they carry one of ``NULL_SPREAD`` numbers
in place of the id, so that they spread over many tasks where the join
shuffles; hot ids are split by the skew-join rule.

A caller with wide facts may ask ``fits_in_memory`` whether the dimension, however
large its file is said to be, is small enough for every executor, and then have it broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Number of spread values for NULL ids.
NULL_SPREAD = 4096
# Most bytes of a dimension that is broadcast: each executor holds it once, about twice that as a hash table.
BROADCAST_BYTES = 128 << 20
# Bytes of an entry besides its name: key, row header and hash slots.
ENTRY_BYTES = 56


def fits_in_memory(dim: DataFrame, key: str = "player_id", value: str = "player_name", most: int = BROADCAST_BYTES) -> bool:
    """Whether a stored dimension is small enough to broadcast, by its rows and names (one aggregate over these columns)."""
    n = dim.filter(F.col(key).isNotNull()).agg(F.sum(F.lit(ENTRY_BYTES) + F.coalesce(F.octet_length(value), F.lit(0)))).first()[0]
    return (n or 0) <= most


def resolve_names(fact: DataFrame, dim: DataFrame, roles: Mapping[str, str], key: str = "player_id",
                  value: str = "player_name", keep_ids: bool = False, spread_on: tuple[str, ...] = (),
                  broadcast: bool = False) -> DataFrame:
    """Left-join ``dim`` once per role and replace each role's id column by the looked-up value.

    ``roles`` maps fact id column -> output column.  The output column takes
    the place of the id column (same position); with ``keep_ids`` the id is
    kept as ``<role>_id`` too.  Unmatched or NULL ids give NULL.  The
    dimension must hold one row per key (see ``silver_players``).  ``broadcast``: the
    dimension is known to fit in memory (``fits_in_memory``), and no fact row is shuffled.
    """
    # The same frame is joined once per role (aliased), so its plan is computed once and reused by every role.
    side = dim.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("__key"), F.col(value).alias("__value"),
                                                     F.lit(True).alias("__is"))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in (spread_on or fact.columns[:4])]), F.lit(NULL_SPREAD))
    out = fact
    for id_col in roles:
        role = f"__dim_{id_col}"
        if broadcast:
            out = out.join(F.broadcast(side.alias(role)), F.col(id_col).cast("long") == F.col(f"{role}.__key"), "left")
            continue
        out = out.join(side.alias(role), (F.coalesce(F.col(id_col).cast("long"), spread) == F.col(f"{role}.__key"))
                       & (F.col(id_col).isNotNull() == F.col(f"{role}.__is")), "left")
    cols: list[Column] = []
    for c in fact.columns:
        if c in roles:
            cols.append(F.col(f"__dim_{c}.__value").alias(roles[c]))
            if keep_ids:
                cols.append(F.col(c).alias(f"{c}_id"))
        else:
            cols.append(F.col(c))
    return out.select(*cols)
