"""Marts (Q10-Q12, J1) and data checks (T1-T3) on hand-made rows."""

import pytest
from trip_values import ts

from tripmart.operators import quality
from tripmart.plans import marts
from tripmart.plans.fact import build_fact
from tripmart.plans.suite import SUITE
from tripmart.schemas import SEEDS, UNIFIED

P = ts("2026-04-10 10:00:00")


def trip(**over):
    r = {"pickup_datetime": P, "dropoff_datetime": P, "pu_location_id": 1, "do_location_id": 2,
         "trip_type": "yellow", "source_file": "y", "fare_amount": 10.0, "trip_distance": 2.0,
         "total_amount": 12.0, "trip_duration_minutes": 10, "pickup_date": P.date(),
         "ingestion_timestamp": P}
    r.update(over)
    return tuple(r.get(f.name) for f in UNIFIED.fields)


def fact(spark, rows):
    return build_fact(spark.createDataFrame(rows, UNIFIED))


def test_hvfhv_revenue_null_and_tips_zero(spark):
    f = fact(spark, [trip(trip_type="hvfhv", total_amount=None, fare_amount=5.0),
                     trip(trip_type="hvfhv", total_amount=None, fare_amount=7.0, pu_location_id=3)])
    d = marts.daily_summary(f).first()
    assert d.trip_count == 2 and d.total_revenue is None and d.avg_fare_amount == 6.0
    r = marts.revenue_breakdown(f).first()
    assert r.grand_total is None and r.fare_amount_total == 12.0 and r.tip_amount_total == 0.0


def test_zone_join_drops_unmatched_and_null(spark):
    zones = spark.createDataFrame([(1, "Queens", "N/A", "Boro"), (2, "Queens", "Same", "Boro"),
                                   (3, "Bronx", "Same", "Boro")], SEEDS["taxi_zone_lookup"])
    f = fact(spark, [trip(pu_location_id=1), trip(pu_location_id=2, fare_amount=1.0),
                     trip(pu_location_id=3, fare_amount=2.0), trip(pu_location_id=99, fare_amount=3.0),
                     trip(pu_location_id=None, fare_amount=4.0)])
    out = {r.pu_location_id: r for r in marts.zone_performance(f, zones).collect()}
    assert set(out) == {1, 2, 3}
    assert out[1].zone == "N/A" and out[2].zone == out[3].zone == "Same"
    assert out[1].trip_count == 1 and out[1].total_revenue == 12.0 and out[1].avg_distance == 2.0


def test_zone_duplicate_dimension_keys_match_join_then_aggregate(spark):
    zones = spark.createDataFrame([(1, "Q", "Z", "s"), (1, "Q", "Z", "s")], SEEDS["taxi_zone_lookup"])
    f = fact(spark, [trip(fare_amount=1.0), trip(fare_amount=3.0)])
    r = marts.zone_performance(f, zones).collect()
    assert len(r) == 1 and r[0].trip_count == 4 and r[0].avg_fare == 2.0


def test_averages_and_sums_keep_all_decimals(spark):
    f = fact(spark, [trip(trip_type="hvfhv", trip_distance=1.234, fare_amount=10.005 + i, total_amount=0.001, tip_amount=0.001)
                     for i in range(3)])
    d = marts.daily_summary(f).first()
    assert d.avg_trip_distance == 1.234 and abs(d.avg_fare_amount - 11.005) < 1e-12 and d.total_revenue == 0.003
    assert marts.revenue_breakdown(f).first().tip_amount_total == 0.003
    zones = spark.createDataFrame([(1, "Q", "Z", "s")], SEEDS["taxi_zone_lookup"])
    assert marts.zone_performance(f, zones).first().avg_distance == 1.234


def test_suite_names_missing_models(spark):
    with pytest.raises(ValueError, match="stg_green_trips"):
        quality.run_suite({"stg_yellow_trips": spark.createDataFrame([], UNIFIED)}, SUITE)


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (None, "zz"), (2, None)], "k int, v string")
    nn = {r.column_name: r.failures for r in quality.check_not_null(df, "k", "v").collect()}
    assert nn == {"k": 2, "v": 2}
    assert quality.check_unique(df, "k").first().failures == 1          # 1 repeats; NULLs ignored
    assert [tuple(r) for r in quality.unique_violations(df, "k").collect()] == [(1, 2)]
    assert quality.check_accepted_values(df, "v", ("a", "b")).first().failures == 1   # NULL passes


def test_suite_has_48_tests():
    n = sum(len(s.not_null) + len(s.unique) + len(s.accepted_values) for s in SUITE)
    assert n == 48
