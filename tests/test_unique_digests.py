"""The incremental unique test: planted repeats within and across dates, without reading untouched dates."""

import datetime as dt
import glob
import os

import pytest

from tripmart.operators.unique_digests import duplicated_keys
from tripmart.operators.upsert import drop_partition
from tripmart.plans import registry
from tripmart.sources.sinks import write_partitioned

DAYS = [dt.date(2024, 1, d) for d in range(1, 8)]


def _write(spark, path, rows):
    df = spark.createDataFrame(rows, "trip_id string, fare double, pickup_date date")
    write_partitioned(df, path, "pickup_date")
    return df.select("pickup_date").distinct()


def _found(df):
    return {r.trip_id: r.n_records for r in df.collect()}


def _day(n, *more):
    return [(f"{n}-{k}", 1.0, DAYS[n]) for k in range(20)] + [(k, 2.0, DAYS[n]) for k in more]


def _spoil(path, day):
    for f in glob.glob(f"{path}/pickup_date={day}/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"no parquet")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_repeats_within_and_across_dates(spark, tmp):
    path, state = os.path.join(tmp, "t"), os.path.join(tmp, "s")
    rows = [r for n in range(5) for r in _day(n)] + [(None, 1.0, DAYS[0]), (None, 1.0, DAYS[0]), ("no date", 1.0, None)]
    assert _found(duplicated_keys(spark, path, state, _write(spark, path, rows))) == {}
    _spoil(path, DAYS[4])  # neither touched nor holding a clash: its rows are not read
    touched = _write(spark, path, _day(5, "5-3", "5-3", "2-7") + [("no date", 1.0, None), ("no date", 1.0, None)])
    assert _found(duplicated_keys(spark, path, state, touched)) == {"5-3": 3, "2-7": 2, "no date": 2}
    touched = _write(spark, path, _day(6, "1-1"))
    assert _found(duplicated_keys(spark, path, state, touched)) == {"5-3": 3, "2-7": 2, "no date": 2, "1-1": 2}
    assert _found(duplicated_keys(spark, path, state, touched)) == {"5-3": 3, "2-7": 2, "no date": 2, "1-1": 2}  # done again
    touched = _write(spark, path, _day(5))  # repeats taken back
    assert _found(duplicated_keys(spark, path, state, touched)) == {"no date": 2, "1-1": 2}
    drop_partition(spark, path, "pickup_date", DAYS[6])  # a date without rows any more
    gone = spark.createDataFrame([(DAYS[6],)], "pickup_date date")
    assert _found(duplicated_keys(spark, path, state, gone)) == {"no date": 2}
    drop_partition(spark, path, "pickup_date", None)
    gone = spark.createDataFrame([(None,)], "pickup_date date")
    assert _found(duplicated_keys(spark, path, state, gone)) == {}


def test_rows_of_a_date_with_a_clash_are_read(spark, tmp):
    path, state = os.path.join(tmp, "t"), os.path.join(tmp, "s")
    _write(spark, path, _day(0) + _day(1))
    assert _found(duplicated_keys(spark, path, state)) == {}
    _spoil(path, DAYS[1])
    with pytest.raises(Exception, match="(?i)parquet"):
        duplicated_keys(spark, path, state, _write(spark, path, _day(2, "1-4"))).collect()


def test_query_equals_full_test(spark):
    got = registry.QUERIES["check_unique_incremental"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["trip_id", "n_records"] and got.count() > 20
