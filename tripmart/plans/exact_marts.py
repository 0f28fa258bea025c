"""Q10-Q12 on doubles as they are: every sum is the double nearest to the true one (``operators/exact_sums``).

The marts of ``plans/marts.py`` take nine decimals and up to 19 digits before them; these have no such
bounds. Zone performance merges states of locations after the join with the zones, so the join sees a few
rows per location on the fact side and a zone that is listed twice counts twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.exact_sums import exact_sums, finish, merge_states, sum_states


def _average(c: str) -> Column:
    return F.col(f"{c}_sum") / F.nullif(F.col(f"{c}_n"), F.lit(0))


def daily_summary(fact: DataFrame) -> DataFrame:
    sums = exact_sums(fact, ["pickup_date", "trip_type"], ["fare_amount", "trip_distance", "trip_duration_minutes", "total_amount"])
    return sums.select("pickup_date", "trip_type", F.col("n_rows").alias("trip_count"),
                       _average("fare_amount").alias("avg_fare_amount"), _average("trip_distance").alias("avg_trip_distance"),
                       _average("trip_duration_minutes").alias("avg_trip_duration_minutes"),
                       F.col("total_amount_sum").alias("total_revenue"))


def revenue_breakdown(fact: DataFrame) -> DataFrame:
    or_zero = {"tip_amount": "tip_amount_total", "tolls_amount": "tolls_amount_total",
               "congestion_surcharge": "surcharge_total", "airport_fee": "airport_fee_total"}
    sums = exact_sums(fact, ["trip_type", "pickup_date"], ["fare_amount", *or_zero, "total_amount"])
    return sums.select("trip_type", "pickup_date", F.col("fare_amount_sum").alias("fare_amount_total"),
                       *[F.coalesce(f"{c}_sum", F.lit(0.0)).alias(name) for c, name in or_zero.items()],
                       F.col("total_amount_sum").alias("grand_total"))


def zone_performance(fact: DataFrame, zones: DataFrame) -> DataFrame:
    columns, keys = ["total_amount", "fare_amount", "trip_distance"], ["pu_location_id", "zone", "borough"]
    places = sum_states(fact.where("pu_location_id IS NOT NULL"), ["pu_location_id"], columns)
    dim = zones.select("LocationID", F.col("Zone").alias("zone"), F.col("Borough").alias("borough"))
    states = places.join(dim, places["pu_location_id"] == dim["LocationID"]).drop("LocationID")
    sums = finish(merge_states(states, keys), keys, columns)
    return sums.select(*keys, F.col("n_rows").alias("trip_count"), F.col("total_amount_sum").alias("total_revenue"),
                       _average("fare_amount").alias("avg_fare"), _average("trip_distance").alias("avg_distance"))
