"""Dedup (W1), surrogate key (X14), incremental fact."""

import os

from trip_values import ts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.functions.expressions import SURROGATE_NULL, surrogate_key
from tripmart.operators.dedup import dedup_latest
from tripmart.plans.fact import build_fact, fact_columns, incremental_batch, refresh_fact
from tripmart.schemas import TRIP_KEY, UNIFIED

P = ts("2026-04-10 10:00:00")
D = ts("2026-04-10 10:30:00")


def trip(**over):
    r = {"pickup_datetime": P, "dropoff_datetime": D, "pu_location_id": 1, "do_location_id": 2,
         "trip_type": "yellow", "source_file": "y.parquet", "fare_amount": 10.0,
         "ingestion_timestamp": ts("2026-05-01 00:00:00"), "pickup_date": P.date(), "tip_amount": 1.0}
    r.update(over)
    return tuple(r.get(f.name) for f in UNIFIED.fields)


def unified(spark, rows):
    return spark.createDataFrame(rows, UNIFIED)


def test_later_ingestion_wins(spark):
    df = unified(spark, [trip(tip_amount=1.0, ingestion_timestamp=ts("2026-05-01 00:00:00")),
                         trip(tip_amount=2.0, ingestion_timestamp=ts("2026-05-02 00:00:00"))])
    out = dedup_latest(df, TRIP_KEY, "ingestion_timestamp").collect()
    assert len(out) == 1 and out[0].tip_amount == 2.0


def test_null_ingestion_first_and_tie_breaker(spark):
    df = unified(spark, [trip(tip_amount=1.0), trip(tip_amount=3.0), trip(tip_amount=2.0)])
    out = dedup_latest(df, TRIP_KEY, "ingestion_timestamp", ["tip_amount"]).collect()
    assert [r.tip_amount for r in out] == [3.0]
    df = unified(spark, [trip(tip_amount=1.0), trip(tip_amount=5.0, ingestion_timestamp=None)])
    out = dedup_latest(df, TRIP_KEY, "ingestion_timestamp").collect()
    assert [r.tip_amount for r in out] == [5.0]


def test_null_keys_compare_equal(spark):
    df = unified(spark, [trip(pu_location_id=None, tip_amount=1.0,
                              ingestion_timestamp=ts("2026-05-01 00:00:00")),
                         trip(pu_location_id=None, tip_amount=2.0,
                              ingestion_timestamp=ts("2026-05-03 00:00:00"))])
    out = dedup_latest(df, TRIP_KEY, "ingestion_timestamp").collect()
    assert len(out) == 1 and out[0].tip_amount == 2.0


rows_strategy = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.one_of(st.none(), st.integers(0, 3)),
                                   st.integers(0, 50)), min_size=1, max_size=40)


def latest_by_hand(rows):
    """The first row per key: ingestion time descending with NULL first, then the tip descending."""
    best = {}
    for k, f, t, tip in rows:
        rank = (t is None, -1 if t is None else t, tip)
        if (k, f) not in best or rank > best[k, f]:
            best[k, f] = rank
    return sorted((k, float(f), float(r[2])) for (k, f), r in best.items())


@settings(max_examples=15, deadline=None)
@given(rows_strategy)
def test_dedup_equals_plain_ranking(spark, rows):
    data = [trip(pu_location_id=k, fare_amount=float(f),
                 ingestion_timestamp=None if t is None else ts(f"2026-05-0{t + 1} 00:00:00"),
                 tip_amount=float(tip)) for k, f, t, tip in rows]
    got = dedup_latest(unified(spark, data), TRIP_KEY, "ingestion_timestamp", ["tip_amount"])
    assert sorted((r.pu_location_id, r.fare_amount, r.tip_amount) for r in got.collect()) == latest_by_hand(rows)


def test_ties_are_broken_by_all_columns(spark):
    rows = [trip(tip_amount=1.0, mta_tax=float(x), store_and_fwd_flag=f) for x, f in ((1, "a"), (2, "b"), (2, "c"))]
    for data in (rows, rows[::-1]):
        got = dedup_latest(unified(spark, data).repartition(3), TRIP_KEY, "ingestion_timestamp", ["tip_amount"]).collect()
        assert len(got) == 1 and (got[0].store_and_fwd_flag, got[0].mta_tax) == ("c", 2.0)


def test_surrogate_key_null_marker(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    got = df.select(surrogate_key("x", "y").alias("k")).first().k
    want = df.select(F.md5(F.lit(f"a-{SURROGATE_NULL}")).alias("k")).first().k
    assert got == want


def _fact_rows(spark, path):
    return sorted((r.trip_id, r.tip_amount, str(r.pickup_date))
                  for r in fact_columns(spark.read.parquet(path)).collect())


def test_incremental_upsert(spark, tmp):
    path = os.path.join(tmp, "fct")
    d1, d2, d3 = (ts(f"2026-04-{d} 10:00:00") for d in ("10", "11", "12"))
    first = unified(spark, [trip(pickup_datetime=d, pickup_date=d.date(), tip_amount=1.0) for d in (d1, d2)])
    refresh_fact(spark, first, path)                       # empty target: full refresh
    assert len(_fact_rows(spark, path)) == 2
    refresh_fact(spark, first, path)                       # rerun: unchanged
    assert [r[1] for r in _fact_rows(spark, path)] == [1.0, 1.0]
    later = ts("2026-05-05 00:00:00")
    batch = unified(spark, [
        trip(pickup_datetime=d1, pickup_date=d1.date(), tip_amount=9.0, ingestion_timestamp=later),  # before mark
        trip(pickup_datetime=d2, pickup_date=d2.date(), tip_amount=7.0, ingestion_timestamp=later),  # at mark
        trip(pickup_datetime=d3, pickup_date=d3.date(), tip_amount=5.0, ingestion_timestamp=later)])  # new
    refresh_fact(spark, batch, path)
    got = {r[2]: r[1] for r in _fact_rows(spark, path)}
    assert got == {"2026-04-10": 1.0, "2026-04-11": 7.0, "2026-04-12": 5.0}
    ids = [r[0] for r in _fact_rows(spark, path)]
    assert len(ids) == len(set(ids))


def test_incremental_batch_scopes(spark, tmp):
    path = os.path.join(tmp, "fct")
    assert incremental_batch(spark, unified(spark, [trip()]), path) is None   # missing target
    y = ts("2026-04-20 10:00:00")
    g = ts("2026-04-10 10:00:00")
    target = unified(spark, [trip(pickup_datetime=y, pickup_date=y.date()),
                             trip(pickup_datetime=g, pickup_date=g.date(), trip_type="green")])
    refresh_fact(spark, target, path)
    new = unified(spark, [trip(pickup_datetime=ts("2026-04-15 10:00:00"), pickup_date=ts("2026-04-15 00:00:00").date(),
                               trip_type="green")])
    assert incremental_batch(spark, new, path, "global").count() == 0     # hidden by yellow's mark
    assert incremental_batch(spark, new, path, "per_type").count() == 1


def test_build_fact_columns(spark):
    f = build_fact(unified(spark, [trip()]))
    assert f.columns[0] == "trip_id" and f.columns[1:] == [x.name for x in UNIFIED.fields]


def test_upsert_keeps_rows_of_a_null_partition(spark, tmp):
    """A batch touching the NULL date partition rewrites it with the kept rows
    plus the batch, not with the batch alone."""
    from tripmart.operators.upsert import upsert
    path = os.path.join(tmp, "t")
    schema = "trip_id string, v int, pickup_date date"
    upsert(spark, path, spark.createDataFrame([("a", 1, None), ("b", 2, None)], schema))
    upsert(spark, path, spark.createDataFrame([("c", 3, None), ("a", 9, None)], schema))
    got = sorted((r.trip_id, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", 9), ("b", 2), ("c", 3)]


def test_upsert_null_partition_survives_a_batch_with_many_dates(spark, tmp):
    """One path for any number of dates: the kept row of the NULL partition stays."""
    import datetime as dt

    from tripmart.operators.upsert import upsert
    path = os.path.join(tmp, "t")
    schema = "trip_id string, v int, pickup_date date"
    day = dt.date(2026, 1, 1)
    upsert(spark, path, spark.createDataFrame([("a", 1, None), ("b", 2, None), ("old", 3, dt.date(1999, 1, 1))], schema))
    many = [(f"n{i}", i, day + dt.timedelta(days=i)) for i in range(120)]
    upsert(spark, path, spark.createDataFrame([("a", 9, None), ("c", 3, None), *many], schema))
    got = {r.trip_id: r.v for r in spark.read.parquet(path).collect()}
    assert got == {"a": 9, "b": 2, "c": 3, "old": 3, **{f"n{i}": i for i in range(120)}}


def test_upsert_removes_its_staged_batch(spark, tmp):
    from tripmart.operators.upsert import upsert
    from tripmart.session import checkpoint_root
    path = os.path.join(tmp, "t")
    schema = "trip_id string, v int, pickup_date date"
    for v in (1, 2):
        upsert(spark, path, spark.createDataFrame([("a", v, P.date())], schema))
    root = os.path.join(checkpoint_root(spark).removeprefix("file:"), "tripmart")
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]
    assert not [x for x in (os.listdir(root) if os.path.isdir(root) else []) if x.startswith("upsert-batch")]
