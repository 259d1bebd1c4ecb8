"""Top-k with a unique tie-break (the reference's LIMITs have none)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int,
          rank_col: str | None = None) -> DataFrame:
    """``orderBy(order).limit(k)``: planned as TakeOrderedAndProject, i.e.
    a per-partition bounded heap of k rows and a k-row merge, never a full
    sort.  ``order`` must end in a unique column for a deterministic result.

    With ``rank_col`` a 1-based rank is attached.  The window runs over the
    k surviving rows only (one partition of at most k rows).
    """
    out = df.orderBy(*order).limit(k)
    if rank_col:
        out = out.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("long"))
    return out
