"""Plan and layout properties the design relies on at scale."""

import os

from trip_values import ts
from pyspark.sql import functions as F

from tripmart.operators.dedup import dedup_latest
from tripmart.operators.upsert import high_water_mark
from tripmart.sources.sinks import write_partitioned


def _plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_dedup_limits_groups_before_the_shuffle(spark, capsys):
    # a third of all rows are copies of one key
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("v"), F.col("id").alias("ts"))
    out = dedup_latest(df, ["k"], "ts")
    plan = _plan(out, capsys)
    tree = plan.split("(1)")[0]
    assert "SortAggregate" not in tree
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")      # listed below = runs before
    hot = out.where("k = 0").collect()
    assert len(hot) == 1 and hot[0].ts == 29997
    assert out.count() == 20001


def test_hot_date_is_split_across_files(spark, tmp):
    day = ts("2026-04-10 00:00:00").date()
    df = spark.range(200000).select(F.lit(day).alias("pickup_date"), F.col("id"),
                                    (F.col("id") * 7919 % 100003).cast("double").alias("x"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256KB")
    try:
        write_partitioned(df.repartition(8), os.path.join(tmp, "hot"))
    finally:
        spark.conf.set(key, before)
    files = [f for f in os.listdir(os.path.join(tmp, "hot", "pickup_date=2026-04-10")) if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(os.path.join(tmp, "hot")).count() == 200000


def test_high_water_mark_prunes_partitions(spark, tmp, capsys):
    path = os.path.join(tmp, "f")
    d = [ts(f"2026-04-{x} 00:00:00").date() for x in ("01", "02", "03")]
    write_partitioned(spark.createDataFrame([(1, d[0]), (2, d[1]), (3, d[2])], "x int, pickup_date date"), path)
    t = spark.read.parquet(path)
    batch = t.where(F.col("pickup_date") >= high_water_mark(spark.read.parquet(path)))
    plan = _plan(batch, capsys)
    part = [ln for ln in plan.splitlines() if ln.startswith("PartitionFilters")][0]
    assert "pickup_date" in part and "Subquery" in part
    assert [r.x for r in batch.collect()] == [3]
