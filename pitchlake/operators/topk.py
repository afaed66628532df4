"""Top-k by a score with a deterministic tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, score: str, k: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the highest ``score`` (NULL scores last), ties broken by
    ``tiebreak`` ascending, NULLs first.  Planned as ``TakeOrderedAndProject``:
    a k-row heap per task and one k-row merge, whatever the input size."""
    order = [F.col(score).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak]
    return df.orderBy(*order).limit(k)
