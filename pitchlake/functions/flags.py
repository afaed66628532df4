"""Outcome, swing and contact flags of a pitch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake.schemas import BARREL_LABEL, IN_ZONE_LABELS, POOR_CONTACT_LABELS, SWING_PATTERN, WHIFF_SUBSTRING


def outcome_flags(events: str = "events", description: str = "description",
                  contact: str = "launch_speed_angle", zone: str = "pitch_zone_catcher_view") -> list[Column]:
    """Boolean flag columns (NULL input gives a NULL flag).

    Outcomes compare ``events`` exactly; strikeouts and walks include the
    double-play and intentional variants.  A whiff is any description
    containing "swinging", a swing matches the swing pattern, so a
    "swinging_pitchout" is a whiff but not a swing.  Contact flags compare
    the contact *label*.
    """
    ev = F.col(events)
    desc = F.col(description)
    lsa = F.col(contact)
    return [
        (ev == "single").alias("is_single"),
        (ev == "double").alias("is_double"),
        (ev == "triple").alias("is_triple"),
        (ev == "home_run").alias("is_hr"),
        ev.isin("strikeout", "strikeout_double_play").alias("is_k"),
        ev.isin("walk", "intent_walk").alias("is_bb"),
        desc.contains(WHIFF_SUBSTRING).alias("is_whiff"),
        desc.rlike(SWING_PATTERN).alias("is_swing"),
        (lsa == BARREL_LABEL).alias("is_barrel"),
        lsa.isin(*POOR_CONTACT_LABELS).alias("is_poor_contact"),
        F.col(zone).isin(*IN_ZONE_LABELS).alias("is_zone_in"),
    ]


def flag_count(flag: str | Column) -> Column:
    """Number of rows where the flag is true; NULL counts as 0 (bigint)."""
    c = F.col(flag) if isinstance(flag, str) else flag
    return F.sum(F.coalesce(c.cast("int"), F.lit(0))).cast("long")


def count_where(cond: Column) -> Column:
    """``count(CASE WHEN cond THEN 1 END)``; NULL conditions do not count."""
    return F.count(F.when(cond, F.lit(1)))
