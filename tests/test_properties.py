"""Pipeline properties on the smallest driver tables."""

from pyspark.sql import functions as F

from tripmart.plans import adapters as A
from tripmart.plans import marts
from tripmart.plans import models as M
from tripmart.plans.ingest import validate
from tripmart.schemas import SERVICES, UNIONED

SF = "/root/testdata/sf0.001"


def test_union_count_is_sum_of_staged(spark):
    staged = sum(M.staged(spark, SF, s).count() for s in UNIONED)
    assert M.unioned(spark, SF).count() == staged


def test_filters_never_add_rows(spark):
    for s in ("yellow", "green", "fhv", "hvfhv"):
        raw = A.service_raw(spark, SF, s, split=False)
        assert validate(raw, SERVICES[s]).count() <= raw.count()
        assert M.ingested(spark, SF, s, split=False).count() <= raw.count()


def test_fact_keys_unique_and_marts_add_up(spark):
    fact = M.fact(spark, SF)
    n = fact.count()
    assert fact.select("trip_id").distinct().count() == n
    assert marts.daily_summary(fact).agg(F.sum("trip_count")).first()[0] == n
    zones = M.zone_dim(spark, SF)
    matched = fact.join(zones, fact.pu_location_id == zones.LocationID, "left_semi").count()
    assert marts.zone_performance(fact, zones).agg(F.sum("trip_count")).first()[0] == matched
    assert marts.revenue_breakdown(fact).count() == marts.daily_summary(fact).count()
