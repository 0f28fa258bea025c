"""Q10-Q12: daily summary, zone performance, revenue breakdown.

All three are grouped aggregates over the fact (partial aggregation before
the shuffle, so a hot date or zone costs one row per map task). The zone
mart aggregates the fact per pickup location *before* joining the zone
dimension, so the join sees one row per location on the fact side whatever
the fact's size, and re-aggregates after the join so duplicate dimension
keys give exactly the join-then-aggregate result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.aggregate import count_rows, exact_avg, exact_sum, exact_sum_or_zero


def daily_summary(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("pickup_date", "trip_type")
                .agg(count_rows().alias("trip_count"),
                     exact_avg("fare_amount").alias("avg_fare_amount"),
                     exact_avg("trip_distance").alias("avg_trip_distance"),
                     F.avg("trip_duration_minutes").alias("avg_trip_duration_minutes"),
                     exact_sum("total_amount").cast("double").alias("total_revenue")))


def revenue_breakdown(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("trip_type", "pickup_date")
                .agg(exact_sum("fare_amount").cast("double").alias("fare_amount_total"),
                     exact_sum_or_zero("tip_amount").cast("double").alias("tip_amount_total"),
                     exact_sum_or_zero("tolls_amount").cast("double").alias("tolls_amount_total"),
                     exact_sum_or_zero("congestion_surcharge").cast("double").alias("surcharge_total"),
                     exact_sum_or_zero("airport_fee").cast("double").alias("airport_fee_total"),
                     exact_sum("total_amount").cast("double").alias("grand_total")))


def zone_performance(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Inner join on ``pu_location_id = LocationID``: unmatched and NULL
    locations drop out. Which side is broadcast, if any, is left to the
    byte-based threshold and adaptive execution."""
    per_loc = (fact.where(F.col("pu_location_id").isNotNull())
                   .groupBy("pu_location_id")
                   .agg(count_rows().alias("n"),
                        exact_sum("total_amount").alias("rev"),
                        exact_sum("fare_amount").alias("fare_sum"), F.count("fare_amount").alias("fare_n"),
                        exact_sum("trip_distance").alias("dist_sum"), F.count("trip_distance").alias("dist_n")))
    dim = zones.select(F.col("LocationID"), F.col("Zone").alias("zone"), F.col("Borough").alias("borough"))
    joined = per_loc.join(dim, per_loc.pu_location_id == dim.LocationID, "inner")
    g = (joined.groupBy("pu_location_id", "zone", "borough")
               .agg(F.sum("n").alias("trip_count"), F.sum("rev").alias("rev"),
                    F.sum("fare_sum").alias("fare_sum"), F.sum("fare_n").alias("fare_n"),
                    F.sum("dist_sum").alias("dist_sum"), F.sum("dist_n").alias("dist_n")))
    return g.select(
        "pu_location_id", "zone", "borough", "trip_count",
        F.col("rev").cast("double").alias("total_revenue"),
        (F.col("fare_sum").cast("double") / F.nullif(F.col("fare_n"), F.lit(0))).alias("avg_fare"),
        (F.col("dist_sum").cast("double") / F.nullif(F.col("dist_n"), F.lit(0))).alias("avg_distance"))
