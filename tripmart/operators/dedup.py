"""Keep the latest row per key (W1 + F10: ``ROW_NUMBER() ... = 1``).

A window with ``row_number() = 1``: Catalyst puts a WindowGroupLimit below the
shuffle, so each map task sends one row per key it has seen, and a key holding
a third of all rows costs one row per map task downstream. The order ends with
all remaining columns, so the winner is determined even when every rank column
ties: a recomputed task after an executor loss picks the same row.

Order: ``order_col`` DESC with NULLs first (the warehouse's NULL order), then
each tie-breaker DESC with NULLs last, then the other columns likewise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order_col: str, tie_breakers: Sequence[str] = (),
                 rank_col: str = "row_num", keep_rank: bool = False) -> DataFrame:
    """The first row of each key; ``keep_rank`` leaves the rank column in (P9 drops it)."""
    named = {*keys, order_col, *tie_breakers}
    rest = [c for c in df.columns if c not in named]
    w = Window.partitionBy(*keys).orderBy(
        F.col(order_col).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in (*tie_breakers, *rest)])
    out = df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1)
    return out if keep_rank else out.drop(rank_col)
