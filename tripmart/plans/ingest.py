"""Q1-Q4: monthly ingest of one ride service, from one config per service.

One lazy plan per job: declared-schema scan -> month range (pushed into the
scan) -> service filters -> derived columns -> partitioned write. Counts come
from ``observe`` in the write stage plus a footer-only raw count, so the data
is read once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.expressions import avg_speed_mph, duration_minutes, ingestion_time, pickup_date
from tripmart.operators import filters as flt
from tripmart.operators.quality import observed
from tripmart.schemas import Service
from tripmart.sources.scan import read_trips
from tripmart.sources.sinks import write_partitioned


def validate(raw: DataFrame, service: Service, month: str | None = None,
             start: _dt.datetime | None = None, end: _dt.datetime | None = None) -> DataFrame:
    """The service's row filters (F1-F7), month range first."""
    df = raw
    if month or start or end:
        df = flt.month_window(df, service.pickup, month, start, end)
    if service.kind == "taxi":
        df = flt.drop_cash_tip(df)
        df = flt.drop_zero(df, "passenger_count")
        df = flt.positive(df, "fare_amount")
    else:
        df = flt.drop_both_null(df, service.pu, service.do)
        # F7 (drop pickup == dropoff when any pickup >= dropoff) removes only
        # rows that F8 removes anyway (duration 0 or NULL), so the output does
        # not depend on it; only its count is reported (see ingest_metrics).
    return df


def derive(df: DataFrame, service: Service, source_file: str | None = None,
           ingested_at: _dt.datetime | str | None = None, zero_minute_filter: bool = True) -> DataFrame:
    """Duration (and speed for taxis), zero-minute filter
    for FHV services, lineage columns, partition key."""
    df = df.withColumn("trip_duration_minutes", duration_minutes(service.pickup, service.dropoff))
    if service.kind == "taxi":
        df = df.withColumn("avg_speed_mph", avg_speed_mph("trip_distance", "trip_duration_minutes"))
    elif zero_minute_filter:
        df = flt.drop_zero_minutes(df)
    src = F.lit(source_file) if source_file is not None else F.col("_metadata.file_name")
    return df.withColumns({"source_file": src, service.ts_col: ingestion_time(ingested_at),
                           "pickup_date": pickup_date(service.pickup)})


def ingest(raw: DataFrame, service: Service, month: str | None = None, source_file: str | None = None,
           ingested_at: _dt.datetime | str | None = None, start: _dt.datetime | None = None,
           end: _dt.datetime | None = None) -> DataFrame:
    """The whole job as one DataFrame (nothing written)."""
    return derive(validate(raw, service, month, start, end), service, source_file, ingested_at)


def probes(service: Service) -> dict:
    p, d = F.col(service.pickup), F.col(service.dropoff)
    if service.kind == "taxi":
        return {"negative_distance": F.col("trip_distance") < 0, "pickup_after_dropoff": p > d}
    return {"pickup_not_before_dropoff": p >= d, "pickup_differs_dropoff": p != d}


def run_ingest(spark: SparkSession, in_path: str | list[str], out_path: str, service: Service,
               month: str | None = None, source_file: str | None = None,
               ingested_at: _dt.datetime | str | None = None, overwrite_scope: str = "dynamic") -> dict:
    """Scan, validate, derive and write one service; returns the run metrics
    (T6): raw, validated and written counts plus the probe counts."""
    paths = [in_path] if isinstance(in_path, str) else list(in_path)
    raw_count = spark.read.parquet(*paths).count()  # no columns read: footer row counts
    raw = read_trips(spark, in_path, service.raw)
    # Rebalance first, observe after it: the counts are then gathered in the
    # write (result) stage, where Spark merges each partition's metrics once
    # even if an executor loss forces earlier stages to be recomputed. The
    # observe is also a barrier, so the zero-minute filter stays above it.
    derived = derive(validate(raw, service, month), service, source_file, ingested_at,
                     zero_minute_filter=False).hint("rebalance", "pickup_date")
    checked, obs_valid = observed(derived, f"{service.name}_validated", probes(service))
    out = flt.drop_zero_minutes(checked) if service.kind != "taxi" else checked
    out, obs_written = observed(out, f"{service.name}_written")
    write_partitioned(out, out_path, "pickup_date", overwrite_scope=overwrite_scope, rebalance=False)
    v, w = obs_valid.get, obs_written.get
    metrics = {"service": service.name, "raw": raw_count, "written": w["rows"], **{k: v[k] for k in v}}
    if service.kind == "taxi":
        metrics["validated"] = v["rows"]
    else:
        # the reference's 'after validation' count: F7 applied only when any
        # pickup >= dropoff was seen
        metrics["validated"] = v["pickup_differs_dropoff"] if v["pickup_not_before_dropoff"] else v["rows"]
    metrics.pop("rows", None)
    return metrics
