"""Upsert into a bucketed table: same rows as a merge by key, touched dates only, no shuffle of the target."""

import glob
import os

from pyspark.sql import functions as F

from tripmart.operators import bucketed as B

SCHEMA = "trip_id string, v int, pickup_date date"


def _rows(spark, rows):
    return spark.createDataFrame(rows, "trip_id string, v int, d string").select("trip_id", "v", F.col("d").cast("date").alias("pickup_date"))


def _table(spark, tmp, name):
    B.declare(spark, name, os.path.join(tmp, name), _rows(spark, []).schema, 3)
    return name


def _content(spark, name):
    return sorted((r.trip_id, r.v, str(r.pickup_date)) for r in spark.table(name).collect())


def _files(tmp, name):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp}/{name}/*/*.parquet")}


def test_replaces_and_adds_in_touched_dates_only(spark, tmp):
    t = _table(spark, tmp, "bucketed_a")
    key = "spark.sql.sources.partitionOverwriteMode"
    before_mode = spark.conf.get(key)
    spark.conf.set(key, "static")  # the table's own setting counts
    try:
        days = ["2026-04-01", "2026-04-02", "2026-04-03", None]
        B.upsert_bucketed(spark, t, _rows(spark, [(f"k{i}", i, days[i % 4]) for i in range(400)]), 3)
        before = _files(tmp, t)
        batch = [(f"k{i}", -i, days[i % 4]) for i in range(0, 400, 2) if days[i % 4] != "2026-04-01"]  # third day only
        batch += [("new", 7, "2026-04-05"), ("null day", 8, None), (None, 9, "2026-04-03")]
        for _ in range(2):  # a run that is done again changes nothing, but for a NULL key, which equals none
            B.upsert_bucketed(spark, t, _rows(spark, [r for r in batch if r[0]]), 3)
        want = {f"k{i}": (i, str(days[i % 4])) for i in range(400)} | {r[0]: (r[1], str(r[2])) for r in batch if r[0]}
        assert _content(spark, t) == sorted((k, *v) for k, v in want.items())
        untouched = {f: at for f, at in _files(tmp, t).items() if "2026-04-01" in f or "2026-04-02" in f}
        assert untouched == {f: at for f, at in before.items() if "2026-04-01" in f or "2026-04-02" in f}
    finally:
        spark.conf.set(key, before_mode)


def test_target_is_not_shuffled(spark, tmp):
    t = _table(spark, tmp, "bucketed_b")
    B.upsert_bucketed(spark, t, spark.range(3000).selectExpr("cast(id AS string) AS trip_id", "1 AS v", "DATE'2026-04-01' + cast(id % 3 AS int) AS pickup_date"), 3)
    spark.range(2000, 4000).selectExpr("cast(id AS string) AS trip_id", "2 AS v", "DATE'2026-04-02' AS pickup_date").write.parquet(f"{tmp}/batch")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        out = B.kept_rows(spark, t, spark.read.parquet(f"{tmp}/batch"))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    join = plan.index("Join")
    scan = plan.index("Bucketed: true")
    left = plan[join:scan]
    assert "Exchange" not in left, plan  # nothing between the join and the target's scan
    assert plan.count("Exchange hashpartitioning(trip_id") == 1, plan
    assert "PartitionFilters" in plan and "2026-04-02" in plan
    assert out.count() == 667


def test_a_declared_folder_is_found_again(spark, tmp):
    t = _table(spark, tmp, "bucketed_c")
    B.upsert_bucketed(spark, t, _rows(spark, [("a", 1, "2026-04-01"), ("b", 2, None)]), 3)
    spark.sql("DROP TABLE bucketed_c")  # external: the files stay
    _table(spark, tmp, "bucketed_c")
    assert _content(spark, t) == [("a", 1, "2026-04-01"), ("b", 2, "None")]


def test_empty_batch_changes_nothing(spark, tmp):
    t = _table(spark, tmp, "bucketed_d")
    B.upsert_bucketed(spark, t, _rows(spark, [("a", 1, "2026-04-01")]), 3)
    B.upsert_bucketed(spark, t, _rows(spark, []), 3)
    assert _content(spark, t) == [("a", 1, "2026-04-01")]
