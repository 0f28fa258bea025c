"""Column expressions. All are built-in Spark expressions, so they stay inside
whole-stage codegen; none needs a Python UDF."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: the marker the surrogate-key convention substitutes for NULL
# inputs, and the separator placed between the inputs.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEP = "-"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole minutes from start to end, truncated toward zero (bigint).
    NULL if either side is NULL."""
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def avg_speed_mph(distance: ColumnOrName, minutes: ColumnOrName, scale: int | None = 2) -> Column:
    """0 for a zero-minute trip, else distance / hours; rounded HALF_UP to
    ``scale`` places (``None`` keeps the unrounded double)."""
    minutes = _col(minutes)
    speed = F.when(minutes == 0, F.lit(0.0)).otherwise(_col(distance) / (minutes / F.lit(60)))
    return speed if scale is None else F.round(speed, scale)


def safe_divide(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """numerator / NULLIF(denominator, 0): NULL instead of a division error."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 over the string forms of the inputs joined by '-', NULL inputs
    replaced by a fixed marker (the dbt_utils convention)."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEP, *parts))


def whole_units(amount: ColumnOrName) -> Column:
    """``cast(x as decimal)``: decimal(10,0), rounded HALF_UP."""
    return _col(amount).cast("decimal(10,0)")


def year_month(ts: ColumnOrName) -> Column:
    """'yyyy-MM' text of a timestamp."""
    return F.date_format(_col(ts), "yyyy-MM")


def pickup_date(ts: ColumnOrName) -> Column:
    """Calendar date of a timestamp (the partition key); the directory names
    equal the 'yyyy-MM-dd' text form."""
    return F.to_date(_col(ts))


def month_bounds(month: str) -> tuple[_dt.datetime, _dt.datetime]:
    """'2026-04' -> (2026-04-01 00:00, 2026-05-01 00:00)."""
    y, m = (int(x) for x in month.split("-"))
    start = _dt.datetime(y, m, 1)
    end = _dt.datetime(y + (m == 12), m % 12 + 1, 1)
    return start, end


def ingestion_time(at: _dt.datetime | str | None = None) -> Column:
    """Ingestion timestamp: ``current_timestamp()`` as wall-clock NTZ, or an
    injected literal for repeatable runs."""
    if at is None:
        return F.localtimestamp()
    return ntz(at)


def ntz(at: _dt.datetime | _dt.date | str) -> Column:
    """A zone-free timestamp literal (constant-folded, so it reaches the scan
    as a pushed filter)."""
    if isinstance(at, str):
        at = _dt.datetime.fromisoformat(at)
    elif not isinstance(at, _dt.datetime):
        at = _dt.datetime(at.year, at.month, at.day)
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
