"""Without an injected stamp, a run's rows carry one wall-clock time of that run."""

import datetime as dt
import os

from test_ingest_rules import BASE_TAXI, taxi_df

from tripmart.plans.ingest import run_ingest
from tripmart.schemas import YELLOW


def _now():
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)  # the session's time zone is UTC


def test_stamp_is_the_time_of_the_run(spark, tmp):
    source, out = os.path.join(tmp, "in"), os.path.join(tmp, "out")
    rows = [(f"r{i}", {"PULocationID": i, "tpep_pickup_datetime": BASE_TAXI["tpep_pickup_datetime"] - dt.timedelta(days=i % 5)})
            for i in range(200)]
    taxi_df(spark, rows).repartition(7).write.parquet(source)
    stamps = []
    for _ in range(2):
        before = _now()
        metrics = run_ingest(spark, source, out, YELLOW, month="2026-04")
        after = _now()
        got = spark.read.parquet(out)
        assert got.schema[YELLOW.ts_col].dataType.simpleString() == "timestamp_ntz"
        found = [r[0] for r in got.select(YELLOW.ts_col).distinct().collect()]
        assert len(found) == 1 and before <= found[0] <= after
        assert metrics["written"] == got.count() == 200
        stamps += found
    assert stamps[0] < stamps[1]
