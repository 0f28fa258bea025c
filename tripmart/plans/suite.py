"""Q13: the declared data tests of every model (48 tests), run as a few
distributed aggregates and returned as one DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.expressions import surrogate_key
from tripmart.operators.quality import ModelTests, run_suite
from tripmart.plans import marts
from tripmart.plans import models as M
from tripmart.plans.adapters import source_file_name
from tripmart.plans.fact import build_fact
from tripmart.schemas import TRIP_KEY, UNIONED
from tripmart.session import scratch_dir
from tripmart.sources.seeds import builtin_seed
from tripmart.sources.sinks import write_table

_TRIP_NN = ("pickup_datetime", "dropoff_datetime", "pu_location_id", "trip_type")
_TYPES = ("yellow", "green", "hvfhv")

# The declared tests of each model.
SUITE: list[ModelTests] = [
    ModelTests("stg_yellow_trips", not_null=_TRIP_NN, accepted_values=(("trip_type", ("yellow",)),)),
    ModelTests("stg_green_trips", not_null=_TRIP_NN, accepted_values=(("trip_type", ("green",)),)),
    ModelTests("stg_fhv_trips", not_null=("pickup_datetime", "dropoff_datetime", "trip_type"),
               accepted_values=(("trip_type", ("fhv",)),)),
    ModelTests("stg_hvfhv_trips", not_null=_TRIP_NN, accepted_values=(("trip_type", ("hvfhv",)),)),
    ModelTests("int_all_trips_unioned",
               not_null=("pickup_datetime", "dropoff_datetime", "source_file", "trip_type"),
               accepted_values=(("trip_type", _TYPES),)),
    ModelTests("dim_taxi_zones", not_null=("locationid",), unique=("locationid",)),
    ModelTests("dim_rate_codes", not_null=("rate_code_id",), unique=("rate_code_id",)),
    ModelTests("dim_vendors", not_null=("vendor_id",), unique=("vendor_id",)),
    ModelTests("dim_payment_types", not_null=("payment_type_id",), unique=("payment_type_id",)),
    ModelTests("dim_hvfhv_bases", not_null=("hvfhs_license_num",), unique=("hvfhs_license_num",)),
    ModelTests("fct_trips",
               not_null=("trip_id", "pickup_datetime", "dropoff_datetime", "trip_type", "source_file"),
               unique=("trip_id",), accepted_values=(("trip_type", _TYPES),)),
    ModelTests("mart_daily_summary", not_null=("pickup_date", "trip_type")),
    ModelTests("mart_zone_performance", not_null=("pu_location_id", "zone", "borough")),
    ModelTests("mart_revenue_breakdown", not_null=("pickup_date", "trip_type")),
]


def build_models(spark: SparkSession, sf_dir: str, planted: bool = False) -> dict[str, DataFrame]:
    """The union and the fact are written once (to the shared checkpoint folder). The unioned
    services' staging models are their rows of the written union, told apart by source file.
    ``planted``: unknown trip types, missing times, and a fact that is not deduplicated."""
    unioned = M.unioned(spark, sf_dir)
    if planted:
        unioned = unioned.withColumns({
            "trip_type": F.expr("CASE WHEN do_location_id % 40 = 0 THEN 'unknown' ELSE trip_type END"),
            "dropoff_datetime": F.expr("CASE WHEN do_location_id % 30 = 0 THEN NULL ELSE dropoff_datetime END")})
    path = scratch_dir(spark, "unioned")
    write_table(unioned, path)
    unioned = spark.read.parquet(path)
    path = scratch_dir(spark, "fct_trips")
    write_table(unioned.select(surrogate_key(*TRIP_KEY).alias("trip_id"), "*") if planted else build_fact(unioned), path)
    fact = spark.read.parquet(path)
    zones = M.zone_dim(spark, sf_dir)
    out = {f"stg_{s}_trips": unioned.where(F.col("source_file") == source_file_name(s)) for s in UNIONED}
    out.update({
        "stg_fhv_trips": M.staged(spark, sf_dir, "fhv"),
        "int_all_trips_unioned": unioned,
        "dim_taxi_zones": zones,
        "dim_rate_codes": builtin_seed(spark, "rate_codes"),
        "dim_vendors": builtin_seed(spark, "vendors"),
        "dim_payment_types": builtin_seed(spark, "payment_types"),
        "dim_hvfhv_bases": builtin_seed(spark, "hvfhv_bases"),
        "fct_trips": fact,
        "mart_daily_summary": marts.daily_summary(fact),
        "mart_zone_performance": marts.zone_performance(fact, zones),
        "mart_revenue_breakdown": marts.revenue_breakdown(fact),
    })
    return out


def test_suite(spark: SparkSession, sf_dir: str, planted: bool = False) -> DataFrame:
    return run_suite(build_models(spark, sf_dir, planted), SUITE)
