"""Column expressions (X1-X15) on edge values."""

import datetime as dt
from decimal import Decimal

from trip_values import ts

from tripmart.functions import expressions as X


def test_expressions(spark):
    df = spark.createDataFrame(
        [(10.0, 0, 2.5, ts("2026-12-31 23:59:59")), (10.0, 4, 0.49, ts("2026-01-01 00:00:00")),
         (None, 2, None, None), (3.0, None, -0.5, ts("2026-02-28 12:00:00"))],
        "n double, d int, tip double, t timestamp_ntz")
    rows = df.select(X.safe_divide("n", "d").alias("q"), X.whole_units("tip").alias("u"),
                     X.year_month("t").alias("ym"), X.pickup_date("t").alias("day"),
                     X.avg_speed_mph("n", "d").alias("s")).collect()
    assert [r.q for r in rows] == [None, 2.5, None, None]               # NULLIF(d, 0): no division error
    assert [r.u for r in rows] == [Decimal("3"), Decimal("0"), None, Decimal("-1")]   # HALF_UP
    assert [r.ym for r in rows] == ["2026-12", "2026-01", None, "2026-02"]
    assert rows[0].day == dt.date(2026, 12, 31)
    assert rows[0].s == 0.0 and rows[1].s == 150.0 and rows[3].s is None


def test_month_bounds_roll_over_the_year():
    assert X.month_bounds("2026-12") == (dt.datetime(2026, 12, 1), dt.datetime(2027, 1, 1))
    assert X.month_bounds("2026-04") == (dt.datetime(2026, 4, 1), dt.datetime(2026, 5, 1))


def test_catalog_sources_models_and_views(spark, tmp):
    """A named source resolves once; a model refs it; models are
    registered as temp views for SQL users."""
    import os
    from tripmart.sources.catalog import Catalog
    path = os.path.join(tmp, "src")
    spark.createDataFrame([(1,), (2,), (3,)], "x int").write.parquet(path)
    cat = (Catalog(spark).add_source("raw_numbers", path)
           .add_model("big_numbers", lambda c: c.ref("raw_numbers").where("x > 1")))
    assert cat.ref("big_numbers").count() == 2
    assert cat.ref("big_numbers") is cat.ref("big_numbers")
    assert spark.sql("SELECT count(*) AS n FROM big_numbers").first().n == 2
