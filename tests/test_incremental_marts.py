"""Marts from partial states: only touched dates are rewritten, and results equal a full build."""

import glob
import os

from pyspark.sql import functions as F

from tripmart.plans import incremental_marts as I
from tripmart.plans import marts
from tripmart.plans import models as M
from tripmart.plans.adapters import RUN_1, RUN_2
from tripmart.plans.fact import fact_columns

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_a_second_run_rewrites_touched_dates_only(spark, tmp):
    fact, states = os.path.join(tmp, "fact"), os.path.join(tmp, "states")
    first = M.unioned(spark, SF, (RUN_1,)).where("pickup_date >= '1997-11-01' AND pickup_date < '1998-01-01'")
    I.incremental_run(spark, first, fact, states)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{states}/*/*.parquet")}
    later = M.unioned(spark, SF, (RUN_2,)).where("pickup_date >= '1997-11-01' AND pickup_date < '1998-01-15'")
    I.incremental_run(spark, later, fact, states)
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{states}/*/*.parquet")}
    mark = max(f.split("pickup_date=")[1][:10] for f in before)
    for f, at in before.items():
        assert (after.get(f) == at) == (f.split("pickup_date=")[1][:10] < mark), f
    trips, zones = fact_columns(spark.read.parquet(fact)), M.zone_dim(spark, SF)
    zones = zones.union(zones.where("LocationID = 3"))  # a zone that is listed twice
    kept = spark.read.parquet(states)
    assert _rows(I.daily_summary(kept)) == _rows(marts.daily_summary(trips))
    assert _rows(I.revenue_breakdown(kept)) == _rows(marts.revenue_breakdown(trips))
    assert _rows(I.zone_performance(kept, zones)) == _rows(marts.zone_performance(trips, zones))


def test_a_date_that_lost_its_trips_loses_its_states(spark, tmp):
    fact, states = os.path.join(tmp, "fact"), os.path.join(tmp, "states")
    trips = M.unioned(spark, SF, (RUN_1,)).where("pickup_date >= '1997-12-20' AND pickup_date < '1998-01-01'")
    I.incremental_run(spark, trips, fact, states)
    dates = sorted(r[0] for r in spark.read.parquet(states).select("pickup_date").distinct().collect())
    I.drop_partition(spark, fact, "pickup_date", dates[0])
    I.refresh_states(spark, fact, states, spark.createDataFrame([(dates[0],)], "pickup_date date"))
    left = spark.read.parquet(states).agg(F.min("pickup_date"), F.countDistinct("pickup_date")).first()
    assert tuple(left) == (dates[1], len(dates) - 1)
