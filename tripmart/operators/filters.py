"""Data-quality filters with the reference's exact NULL semantics.

Each function returns a DataFrame (lazy); all predicates are built-in
expressions so Catalyst can push the range and null checks into the scan.
A ``where`` on a predicate that evaluates to NULL drops the row, so e.g.
``passenger_count != 0`` also drops NULL passenger counts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.expressions import duration_minutes, month_bounds, ntz, whole_units

CASH = 2


def cash_tip_predicate(payment: str, tip: str) -> Column:
    """True for cash trips whose tip rounds (HALF_UP) to a positive whole unit."""
    return (F.col(payment) == CASH) & (whole_units(tip) > 0)


def drop_cash_tip(df: DataFrame, payment: str = "payment_type", tip: str = "tip_amount") -> DataFrame:
    """drop cash payments with a (rounded) tip. NULL-predicate rows are
    dropped too: cash with NULL tip, NULL payment with rounded tip > 0."""
    return df.where(~cash_tip_predicate(payment, tip))


def month_window(df: DataFrame, ts: str, month: str | None = None,
                 start: _dt.datetime | None = None, end: _dt.datetime | None = None) -> DataFrame:
    """keep ``start <= ts < end`` (one month by default). Written as a
    half-open range on the raw timestamp so the scan gets it as a pushed
    filter (the 'yyyy-MM' text comparison cannot be pushed). NULL ts drops."""
    if month is not None:
        start, end = month_bounds(month)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= ntz(start))
    if end is not None:
        cond = cond & (F.col(ts) < ntz(end))
    return df.where(cond)


def drop_zero(df: DataFrame, column: str = "passenger_count") -> DataFrame:
    """keep ``column != 0`` (NULL dropped)."""
    return df.where(F.col(column) != 0)


def positive(df: DataFrame, column: str = "fare_amount") -> DataFrame:
    """keep ``column > 0`` (NULL dropped)."""
    return df.where(F.col(column) > 0)


def drop_both_null(df: DataFrame, a: str, b: str) -> DataFrame:
    """drop rows where both columns are NULL; one NULL is kept."""
    return df.where(~(F.col(a).isNull() & F.col(b).isNull()))


def equal_time_predicate(pickup: str, dropoff: str) -> Column:
    return F.col(pickup) == F.col(dropoff)


def drop_zero_minutes(df: DataFrame, minutes: str = "trip_duration_minutes") -> DataFrame:
    """F8: drop zero-minute trips; NULL duration drops, negative durations of
    a minute or more stay."""
    return df.where(~(F.col(minutes) == 0))


def drop_zero_minute_trips(df: DataFrame, pickup: str, dropoff: str) -> DataFrame:
    """F8 on timestamps: whole-minute difference must be non-zero."""
    return df.where(~(duration_minutes(pickup, dropoff) == 0))


def at_or_after(df: DataFrame, column: str, bound: Column) -> DataFrame:
    """``column >= bound`` where bound may be a scalar subquery / literal."""
    return df.where(F.col(column) >= bound)


def is_null(df: DataFrame, column: str) -> DataFrame:
    """F11."""
    return df.where(F.col(column).isNull())
