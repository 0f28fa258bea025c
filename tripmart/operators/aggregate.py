"""Grouped aggregates used by the marts.

Money and distance sums are taken as ``decimal(28,9)``: nine decimals keep
the inputs as they are (no value is rounded to cents before it is summed or
averaged), and a decimal sum is independent of the summation order, so results
do not change with the number of partitions or with a task retry. Averages are
that sum (as double) over the non-NULL count. ``sum`` is NULL when every input is NULL; the
``*_or_zero`` form is the ``SUM(COALESCE(x, 0))`` variant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SUM = "decimal(28,9)"


def count_rows() -> Column:
    """A1: COUNT(*)."""
    return F.count(F.lit(1))


def exact_sum(c: str) -> Column:
    """A3: SUM, NULL when all inputs are NULL."""
    return F.sum(F.col(c).cast(MONEY_SUM))


def exact_sum_or_zero(c: str) -> Column:
    """A4: SUM(COALESCE(x, 0)), 0 when all inputs are NULL."""
    return F.sum(F.coalesce(F.col(c).cast(MONEY_SUM), F.lit(0).cast(MONEY_SUM)))


def exact_avg(c: str) -> Column:
    """A2: AVG ignoring NULLs (NULL for an all-NULL group)."""
    return exact_sum(c).cast("double") / F.nullif(F.count(F.col(c)), F.lit(0))
