"""Edge rows of the ingest rules (FIXTURES §5): filters F1-F8 and derived
columns X3/X7, with exact NULL semantics."""

from trip_values import ts

from tripmart.plans.ingest import ingest, validate
from tripmart.schemas import FHV, FHV_RAW, YELLOW, YELLOW_RAW

BASE_TAXI = {
    "VendorID": 1, "tpep_pickup_datetime": ts("2026-04-10 10:00:00"),
    "tpep_dropoff_datetime": ts("2026-04-10 10:30:00"), "passenger_count": 1, "trip_distance": 10.0,
    "RatecodeID": 1, "PULocationID": 1, "DOLocationID": 2, "payment_type": 1, "fare_amount": 10.0,
    "tip_amount": 1.0, "total_amount": 12.0,
}


def taxi_df(spark, rows):
    data = []
    for label, over in rows:
        r = dict(BASE_TAXI, **over, store_and_fwd_flag=label)
        data.append(tuple(r.get(f.name) for f in YELLOW_RAW.fields))
    return spark.createDataFrame(data, YELLOW_RAW)


TAXI_CASES = [
    ("cash_tip_030", {"payment_type": 2, "tip_amount": 0.30}, True),
    ("cash_tip_050", {"payment_type": 2, "tip_amount": 0.50}, False),
    ("cash_tip_null", {"payment_type": 2, "tip_amount": None}, False),
    ("nullpay_tip_1", {"payment_type": None, "tip_amount": 1.00}, False),
    ("nullpay_tip_0", {"payment_type": None, "tip_amount": 0.00}, True),
    ("card_tip_5", {"payment_type": 1, "tip_amount": 5.00}, True),
    ("card_tip_null", {"payment_type": 1, "tip_amount": None}, True),
    ("pick_0331", {"tpep_pickup_datetime": ts("2026-03-31 23:59:59")}, False),
    ("pick_0401", {"tpep_pickup_datetime": ts("2026-04-01 00:00:00")}, True),
    ("pick_0430", {"tpep_pickup_datetime": ts("2026-04-30 23:59:59"),
                   "tpep_dropoff_datetime": ts("2026-05-01 00:20:00")}, True),
    ("pick_0501", {"tpep_pickup_datetime": ts("2026-05-01 00:00:00")}, False),
    ("pick_null", {"tpep_pickup_datetime": None}, False),
    ("pax_0", {"passenger_count": 0}, False),
    ("pax_null", {"passenger_count": None}, False),
    ("pax_1", {"passenger_count": 1}, True),
    ("fare_0", {"fare_amount": 0.0}, False),
    ("fare_neg", {"fare_amount": -1.0}, False),
    ("fare_null", {"fare_amount": None}, False),
    ("fare_001", {"fare_amount": 0.01}, True),
    ("dist_neg", {"trip_distance": -1.0}, True),
    ("pick_after_drop", {"tpep_dropoff_datetime": ts("2026-04-10 09:50:00")}, True),
    ("drop_null", {"tpep_dropoff_datetime": None}, True),
    ("dur_59s", {"tpep_dropoff_datetime": ts("2026-04-10 10:00:59")}, True),
]


def test_taxi_filters(spark):
    df = taxi_df(spark, [(label, over) for label, over, _ in TAXI_CASES])
    kept = {r.store_and_fwd_flag for r in validate(df, YELLOW, "2026-04").collect()}
    expected = {label for label, _, keep in TAXI_CASES if keep}
    assert kept == expected


def test_taxi_derived(spark):
    df = taxi_df(spark, [(label, over) for label, over, _ in TAXI_CASES])
    out = {r.store_and_fwd_flag: r for r in ingest(df, YELLOW, "2026-04", source_file="f.parquet",
                                                    ingested_at="2026-05-01 00:00:00").collect()}
    assert out["card_tip_5"].trip_duration_minutes == 30
    assert out["card_tip_5"].avg_speed_mph == 20.0
    assert out["pick_after_drop"].trip_duration_minutes == -10
    assert out["pick_after_drop"].avg_speed_mph < 0
    assert out["dist_neg"].avg_speed_mph < 0
    assert out["drop_null"].trip_duration_minutes is None and out["drop_null"].avg_speed_mph is None
    assert out["dur_59s"].trip_duration_minutes == 0 and out["dur_59s"].avg_speed_mph == 0.0
    r = out["pick_0430"]
    assert str(r.pickup_date) == "2026-04-30" and r.source_file == "f.parquet"
    assert r.ingested_at_timestamp == ts("2026-05-01 00:00:00")


BASE_FHV = {"dispatching_base_num": "B1", "pickup_datetime": ts("2026-04-10 10:00:00"),
            "dropOff_datetime": ts("2026-04-10 10:20:00"), "PUlocationID": 1, "DOlocationID": 2}

FHV_CASES = [
    ("both_null", {"PUlocationID": None, "DOlocationID": None}, None),
    ("one_null", {"PUlocationID": None}, 20),
    ("equal", {"dropOff_datetime": ts("2026-04-10 10:00:00")}, None),
    ("after_59s", {"dropOff_datetime": ts("2026-04-10 10:00:59")}, None),
    ("before_59s", {"dropOff_datetime": ts("2026-04-10 09:59:01")}, None),
    ("before_90s", {"dropOff_datetime": ts("2026-04-10 09:58:30")}, -1),
    ("drop_null", {"dropOff_datetime": None}, None),
    ("normal", {}, 20),
]


def test_fhv_rules(spark):
    data = []
    for label, over, _ in FHV_CASES:
        r = dict(BASE_FHV, **over, Affiliated_base_number=label)
        data.append(tuple(r.get(f.name) for f in FHV_RAW.fields))
    df = spark.createDataFrame(data, FHV_RAW)
    out = {r.Affiliated_base_number: r.trip_duration_minutes
           for r in ingest(df, FHV, "2026-04", source_file="fhv.parquet").collect()}
    assert out == {label: m for label, _, m in FHV_CASES if m is not None}


def test_month_range_is_pushed_to_scan(spark, tmp, capsys):
    df = taxi_df(spark, [("a", {})])
    df.write.parquet(tmp + "/m")
    validate(spark.read.schema(YELLOW_RAW).parquet(tmp + "/m"), YELLOW, "2026-04").explain("formatted")
    pushed = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed and "LessThan(tpep_pickup_datetime" in pushed


def test_fhv_run_metrics_follow_the_conditional_rule(spark, tmp):
    """T6 for FHV: 'validated' drops pickup == dropoff only when some row has
    pickup >= dropoff; 'written' is after the zero-minute filter."""
    import os
    from tripmart.plans.ingest import run_ingest

    def write(rows, name):
        data = []
        for label, over in rows:
            r = dict(BASE_FHV, **over, Affiliated_base_number=label)
            data.append(tuple(r.get(f.name) for f in FHV_RAW.fields))
        path = os.path.join(tmp, name)
        spark.createDataFrame(data, FHV_RAW).write.parquet(path)
        return path

    with_equal = write([("equal", {"dropOff_datetime": ts("2026-04-10 10:00:00")}),
                        ("both_null", {"PUlocationID": None, "DOlocationID": None}),
                        ("ok1", {}), ("ok2", {}), ("short", {"dropOff_datetime": ts("2026-04-10 10:00:30")})], "a")
    m = run_ingest(spark, with_equal, os.path.join(tmp, "out_a"), FHV, month="2026-04", source_file="f.parquet")
    assert (m["raw"], m["validated"], m["written"]) == (5, 3, 2)

    no_equal = write([("ok1", {}), ("short", {"dropOff_datetime": ts("2026-04-10 10:00:30")})], "b")
    m = run_ingest(spark, no_equal, os.path.join(tmp, "out_b"), FHV, month="2026-04", source_file="f.parquet")
    assert (m["raw"], m["validated"], m["written"]) == (2, 2, 1)
