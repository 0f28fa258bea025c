"""Streaming ingest + fact (availableNow), and the driver entry contract."""

import os

import pytest
from trip_values import ts

import __spark_entry__ as E
from tripmart.plans.fact import fact_columns
from tripmart.schemas import YELLOW_RAW
from tripmart.streaming.incremental import fact_stream, ingest_stream


def _month_file(spark, path, day, tip):
    rows = []
    for i in range(3):
        r = {"VendorID": 1, "tpep_pickup_datetime": ts(f"2026-04-{day} 10:0{i}:00"),
             "tpep_dropoff_datetime": ts(f"2026-04-{day} 10:30:00"), "passenger_count": 1,
             "trip_distance": 3.0, "PULocationID": i, "DOLocationID": 2, "payment_type": 1,
             "fare_amount": 10.0, "tip_amount": tip, "total_amount": 12.0}
        rows.append(tuple(r.get(f.name) for f in YELLOW_RAW.fields))
    spark.createDataFrame(rows, YELLOW_RAW).coalesce(1).write.mode("append").parquet(path)


def test_stream_ingest_then_fact(spark, tmp):
    landing, lake, fct = (os.path.join(tmp, x) for x in ("landing", "lake", "fct"))
    ck = os.path.join(tmp, "ck")
    _month_file(spark, landing, "10", 1.0)
    q = ingest_stream(spark, "yellow", landing, lake, month="2026-04", source_file="y.parquet",
                      ingested_at="2026-05-01 00:00:00", checkpoint=ck + "/i")
    q.awaitTermination()
    f = fact_stream(spark, {"yellow": lake}, fct, checkpoint=ck + "/f")
    f.awaitTermination()
    assert fact_columns(spark.read.parquet(fct)).count() == 3

    # a second file arrives: same trips re-delivered later plus new ones
    _month_file(spark, landing, "11", 2.0)
    ingest_stream(spark, "yellow", landing, lake, month="2026-04", source_file="y.parquet",
                  ingested_at="2026-05-02 00:00:00", checkpoint=ck + "/i").awaitTermination()
    fact_stream(spark, {"yellow": lake}, fct, checkpoint=ck + "/f").awaitTermination()
    out = fact_columns(spark.read.parquet(fct))
    assert out.count() == 6
    assert out.select("trip_id").distinct().count() == 6


def test_entry_contract(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"pickup_date", "trip_type", "trip_count", "avg_fare_amount",
                               "avg_trip_distance", "avg_trip_duration_minutes", "total_revenue"}
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_project_with_raw_tables(spark, tmp):
    """Q5-Q13 on a small lake: raw tables materialized, views, fact, marts, tests."""
    from tripmart.plans.ingest import ingest
    from tripmart.plans.project import run_project, test_project
    from tripmart.schemas import YELLOW
    from tripmart.sources.sinks import write_partitioned
    landing = os.path.join(tmp, "landing")
    _month_file(spark, landing, "10", 1.0)
    lake = os.path.join(tmp, "lake")
    write_partitioned(ingest(spark.read.schema(YELLOW_RAW).parquet(landing), YELLOW, "2026-04",
                             source_file="y.parquet", ingested_at="2026-05-01 00:00:00"), lake)
    zones = spark.createDataFrame([(0, "Q", "Z0", "s"), (1, "Q", "Z1", "s")],
                                  "LocationID int, Borough string, Zone string, service_zone string")
    with pytest.raises(ValueError, match="green, hvfhv"):
        run_project(spark, {"yellow": lake}, os.path.join(tmp, "wh"), seeds={"taxi_zone_lookup": zones})
    with pytest.raises(ValueError, match="taxi_zone_lookup"):
        run_project(spark, {"yellow": lake}, os.path.join(tmp, "wh"), services=("yellow",))
    paths = run_project(spark, {"yellow": lake}, os.path.join(tmp, "wh"), seeds={"taxi_zone_lookup": zones},
                        materialize_raw=True, services=("yellow",))
    assert spark.read.parquet(paths["raw_yellow"]).schema["fare_amount"].dataType.simpleString() == "decimal(10,2)"
    assert spark.read.parquet(paths["mart_daily_summary"]).first().trip_count == 3
    assert spark.read.parquet(paths["mart_zone_performance"]).count() == 2
    failures = {(r.model, r.column_name, r.test): r.failures
                for r in test_project(spark, {"yellow": lake}, paths, services=("yellow",)).collect()}
    assert failures[("fct_trips", "trip_id", "unique")] == 0
    assert failures[("stg_yellow_trips", "trip_type", "accepted_values")] == 0
    assert len(failures) == 48 - 5 - 4 - 5   # every test of the models built (no green/fhv/hvfhv staging)
