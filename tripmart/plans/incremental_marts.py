"""Q10-Q12 kept up to date: partial states per date, replaced for touched dates only and merged into the marts.

A state row holds count, sums and non-NULL counts of one (pickup_date, trip_type, pu_location_id): what
every mart needs, since sums of sums and sums of counts are those of the whole. States are partitioned by
date like the fact. A run reads the fact's touched dates, overwrites their states, and merges states into
marts; a month's run costs that month of the fact and the states, which have no row per trip. Sums stay
exact decimals until the end, so the marts equal a full build to the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.aggregate import count_rows, exact_sum
from tripmart.operators.upsert import drop_partition, upsert
from tripmart.plans.fact import fact_columns, incremental_batch, latest_trips, trip_id
from tripmart.session import drop_scratch, scratch_dir
from tripmart.sources.sinks import write_partitioned

KEYS = ("pickup_date", "trip_type", "pu_location_id")
MONEY = ("fare_amount", "trip_distance", "total_amount", "tip_amount", "tolls_amount", "congestion_surcharge", "airport_fee")


def partial_states(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*KEYS).agg(
        count_rows().alias("n"), F.sum("trip_duration_minutes").alias("minutes"), F.count("trip_duration_minutes").alias("minutes_n"),
        *[exact_sum(c).alias(c) for c in MONEY], *[F.count(c).alias(f"{c}_n") for c in MONEY])


def refresh_states(spark: SparkSession, fact_path: str, states_path: str, touched: DataFrame | None = None) -> None:
    """States of the dates in ``touched`` (pickup_date; a written table), of all dates without it."""
    fact = fact_columns(spark.read.parquet(fact_path))
    if touched is None:
        write_partitioned(partial_states(fact), states_path, "pickup_date", overwrite_scope="static")
        return
    dates = touched.select("pickup_date").distinct()
    p = F.col("pickup_date")
    low, high = (dates.select(f(p)).scalar() for f in (F.min, F.max))
    near = fact.where(p.between(low, high) | (p.isNull() & dates.where(p.isNull()).exists()))
    wanted = dates.withColumnRenamed("pickup_date", "_touched")
    write_partitioned(partial_states(near.join(wanted, p.eqNullSafe(F.col("_touched")), "left_semi")), states_path, "pickup_date")
    have = spark.read.parquet(fact_path).select("pickup_date").distinct().withColumnRenamed("pickup_date", "_have")
    for row in wanted.join(have, F.col("_touched").eqNullSafe(F.col("_have")), "left_anti").collect():  # dates without trips now
        drop_partition(spark, states_path, "pickup_date", row[0])


def incremental_run(spark: SparkSession, unioned: DataFrame, fact_path: str, states_path: str) -> None:
    """One run: the batch into the fact, then the states of the batch's dates."""
    batch = incremental_batch(spark, unioned, fact_path)
    if batch is None:  # all rows are new: they are written once, into the fact
        upsert(spark, fact_path, latest_trips(unioned), key="trip_id", partition_col="pickup_date", computed=trip_id())
        refresh_states(spark, fact_path, states_path)
        return
    path = scratch_dir(spark, "batch")
    rows = latest_trips(batch)
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    upsert(spark, fact_path, rows, key="trip_id", partition_col="pickup_date", computed=trip_id(), staged=True)
    refresh_states(spark, fact_path, states_path, rows)
    drop_scratch(spark, path)


def _total(c: str) -> Column:
    return F.sum(c).cast("double")


def _average(c: str, n: str | None = None) -> Column:
    return F.sum(c).cast("double") / F.nullif(F.sum(n or f"{c}_n"), F.lit(0))


def daily_summary(states: DataFrame) -> DataFrame:
    return states.groupBy("pickup_date", "trip_type").agg(
        F.sum("n").alias("trip_count"), _average("fare_amount").alias("avg_fare_amount"),
        _average("trip_distance").alias("avg_trip_distance"), _average("minutes").alias("avg_trip_duration_minutes"),
        _total("total_amount").alias("total_revenue"))


def revenue_breakdown(states: DataFrame) -> DataFrame:
    def or_zero(c: str) -> Column:
        return F.coalesce(_total(c), F.lit(0.0))

    return states.groupBy("trip_type", "pickup_date").agg(
        _total("fare_amount").alias("fare_amount_total"), or_zero("tip_amount").alias("tip_amount_total"),
        or_zero("tolls_amount").alias("tolls_amount_total"), or_zero("congestion_surcharge").alias("surcharge_total"),
        or_zero("airport_fee").alias("airport_fee_total"), _total("total_amount").alias("grand_total"))


def zone_performance(states: DataFrame, zones: DataFrame) -> DataFrame:
    """States are merged per location before the zones are joined, and again after (a zone listed twice counts twice, as in
    the full build)."""
    sums = ("n", "total_amount", "fare_amount", "fare_amount_n", "trip_distance", "trip_distance_n")
    places = states.where("pu_location_id IS NOT NULL").groupBy("pu_location_id").agg(*[F.sum(c).alias(c) for c in sums])
    dim = zones.select("LocationID", F.col("Zone").alias("zone"), F.col("Borough").alias("borough"))
    return places.join(dim, places["pu_location_id"] == dim["LocationID"]).groupBy("pu_location_id", "zone", "borough").agg(
        F.sum("n").alias("trip_count"), _total("total_amount").alias("total_revenue"),
        _average("fare_amount").alias("avg_fare"), _average("trip_distance").alias("avg_distance"))
