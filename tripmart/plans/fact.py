"""Q9: the deduplicated trip fact, full or incremental.

    fact = dedup_latest(unioned, TRIP_KEY, ingestion_timestamp DESC)
           + trip_id = surrogate_key(TRIP_KEY)

Incremental: rows with ``pickup_date >= MAX(pickup_date)`` of the existing
fact (a scalar subquery that becomes a partition filter) are deduplicated
and upserted on ``trip_id``. A missing or empty target is a full refresh.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.expressions import surrogate_key
from tripmart.operators.dedup import dedup_latest
from tripmart.operators.quality import ModelTests
from tripmart.operators.upsert import high_water_mark, read_if_exists, upsert
from tripmart.plans.publish import publish_upsert
from tripmart.schemas import FACT, TRIP_KEY

# Deterministic order among rows that tie on the ingestion timestamp.
TIE_BREAKERS = ("trip_duration_minutes", "tip_amount", "total_amount", "trip_distance",
                "passenger_count", "payment_type", "vendor_id")


def trip_id() -> dict[str, Column]:
    """What follows from a trip's other columns: writers add it behind their shuffles (an md5 does not compress)."""
    return {"trip_id": surrogate_key(*TRIP_KEY)}


def latest_trips(unioned: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    """The fact's rows without their trip_id."""
    return dedup_latest(unioned, TRIP_KEY, "ingestion_timestamp", tie_breakers)


def build_fact(unioned: DataFrame, tie_breakers: Sequence[str] = TIE_BREAKERS) -> DataFrame:
    return latest_trips(unioned, tie_breakers).select(surrogate_key(*TRIP_KEY).alias("trip_id"), *unioned.columns)


def fact_columns(df: DataFrame) -> DataFrame:
    """Fact columns in their declared order (a partitioned read-back puts
    ``pickup_date`` last)."""
    return df.select(*[F.col(f.name) for f in FACT.fields])


def incremental_batch(spark: SparkSession, unioned: DataFrame, target_path: str,
                      scope: str = "global") -> DataFrame | None:
    """the rows to (re)load. ``scope='global'`` is the reference's one
    high-water mark over all trip types; 'per_type' keeps one per type.
    None means full refresh (no target); a target without rows takes every row."""
    target = read_if_exists(spark, target_path)
    if target is None:
        return None
    if scope == "per_type":
        marks = target.groupBy("trip_type").agg(F.max("pickup_date").alias("_mark"))
        return (unioned.join(marks, "trip_type", "left")
                       .where(F.col("_mark").isNull() | (F.col("pickup_date") >= F.col("_mark")))
                       .drop("_mark").select(*unioned.columns))
    mark = high_water_mark(target)  # NULL for a target without rows: everything is to be loaded
    return unioned.where(F.coalesce(F.col("pickup_date") >= mark, mark.isNull()))


def refresh_fact(spark: SparkSession, unioned: DataFrame, target_path: str,
                 scope: str = "global", tests: ModelTests | None = None) -> None:
    """Materialize the fact at ``target_path``: incremental when it exists. With ``tests``, nothing
    changes unless the partitions that the run touches pass them; else an error names the failures."""
    batch = incremental_batch(spark, unioned, target_path, scope)
    rows = unioned if batch is None else batch
    if tests is not None:
        failed = publish_upsert(spark, target_path, fact_columns(build_fact(rows)), tests, key="trip_id", partition_col="pickup_date")
        if failed:
            raise ValueError("fct_trips not published: " + ", ".join(f"{t} of {c} ({n})" for c, t, n in failed))
        return
    upsert(spark, target_path, latest_trips(rows), key="trip_id", partition_col="pickup_date", computed=trip_id())
