"""A load of files that are laid out by date: no row is shuffled for the table, and nothing is left on disk but the table."""

import glob
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tripmart.plans import adapters as A
from tripmart.plans import load as P
from tripmart.plans import models as M
from tripmart.session import settings, smaller_pieces
from tripmart.sources import load as L
from tripmart.sources import sinks

SF = "/root/testdata/sf0.001"


def _trips(spark, days=5, rows=200):
    return spark.range(rows).select(
        F.lit("HV0003").alias("hvfhs_license_num"), F.expr(f"timestamp_ntz '2026-04-01 10:00:00' + make_dt_interval(cast(id % {days} AS INT))").alias("pickup_datetime"),
        F.col("id").cast("double").alias("trip_miles"))


def _lake(spark, path, by_date, days=5):
    trips = _trips(spark, days).withColumn("pickup_date", F.to_date("pickup_datetime"))
    if by_date:
        sinks.write_partitioned(trips, path)
    else:
        trips.repartition(4).write.parquet(path)  # each file holds rows of all dates


def _content(df):
    return sorted(map(str, df.select("trip_miles", "pickup_datetime", "pickup_date").collect()))


@pytest.mark.parametrize("by_date", [True, False])
def test_files_of_one_date_are_written_without_a_shuffle(spark, tmp, monkeypatch, by_date):
    copies, dealt = [], []
    real, write = P.scratch_dir, sinks.write_partitioned
    monkeypatch.setattr(P, "scratch_dir", lambda s, name: copies.append(real(s, name)) or copies[-1])
    for module in (P, sinks):
        monkeypatch.setattr(module, "write_partitioned", lambda *a, **b: dealt.append(b.get("rebalance", True)) or write(*a, **b))
    lake, table = os.path.join(tmp, "lake"), os.path.join(tmp, "table")
    _lake(spark, lake, by_date, 40)
    dealt.clear()
    with settings(spark, {"spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes")}):  # a task for each file
        assert {r.status for r in P.run_load(spark, lake, "hvfhv", table).collect()} == {"ok"}
    assert dealt == [not by_date]
    got = spark.read.parquet(table)
    assert _content(got) == _content(_trips(spark, 40).withColumn("pickup_date", F.to_date("pickup_datetime")))
    assert L.FILE not in got.columns and len(glob.glob(f"{table}/**/*.parquet", recursive=True)) == 40
    staged = [c for c in copies if "staged" in c]
    assert staged and not any(os.path.exists(c.removeprefix("file:")) for c in staged)


def test_a_bad_file_is_still_set_aside(spark, tmp):
    lake, table = os.path.join(tmp, "lake"), os.path.join(tmp, "table")
    _lake(spark, lake, True)
    _trips(spark).withColumns({"trip_duration_minutes": F.lit(1 << 40)}).coalesce(1).write.mode("append").parquet(f"{lake}/late")
    assert sorted(r.status for r in P.run_load(spark, lake, "hvfhv", table).collect()) == ["cast overflow"] + ["ok"] * 5
    assert spark.read.parquet(table).count() == 200


def test_laid_out_counts_files_dates_and_bytes(spark, tmp, monkeypatch):
    for name, by_date in (("a", True), ("b", False)):
        _lake(spark, f"{tmp}/{name}", by_date, 40)
    schema = "trip_miles double, pickup_date date"
    assert sinks.laid_out(spark.read.schema(schema).parquet(f"{tmp}/a"))
    assert not sinks.laid_out(spark.read.schema(schema).parquet(f"{tmp}/b"))
    assert sinks.laid_out(spark.read.schema(schema).parquet(f"{tmp}/b").where("pickup_date = '2026-04-02'"))
    monkeypatch.setattr(sinks, "SMALL", 1)  # files of some bytes are large enough
    assert sinks.laid_out(spark.read.schema(schema).parquet(f"{tmp}/b"))


def test_a_staged_file_has_a_bounded_number_of_rows(spark, tmp, monkeypatch):
    monkeypatch.setattr(L, "STAGED_ROWS", 30)
    _lake(spark, f"{tmp}/lake", False)
    staged, files = L.stage_files(spark, f"{tmp}/lake", P.SERVICES["hvfhv"], P._footers(spark, f"{tmp}/lake"), staged=f"{tmp}/copy")
    assert staged.count() == 200 and {r.status for r in files.collect()} == {"ok"}
    assert max(r["count"] for r in staged.groupBy(F.col("_metadata.file_path")).count().collect()) <= 30
    P.run_load(spark, f"{tmp}/lake", "hvfhv", f"{tmp}/table")
    assert spark.read.parquet(f"{tmp}/table").count() == 200


def test_trips_are_dealt_by_date_before_they_are_sent_again_and_shaped(spark):
    for service in ("hvfhv", "yellow", "fhv"):
        plain, dealt = (M.ingested(spark, SF, service, split=False, by_date=x) for x in (False, True))
        assert plain.columns == dealt.columns and plain.exceptAll(dealt).isEmpty() and dealt.exceptAll(plain).isEmpty()
    plan = A.hvfhv_raw(spark, SF, by_date=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS hvfhs_license_num") < plan.index("Generate explode") < plan.index("RebalancePartitions") < plan.index("Join Inner")


def test_settings_hold_within_only(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, sizes = spark.conf.get(key), []
    with pytest.raises(ZeroDivisionError), settings(spark, {key: "9m", "spark.tripmart.none": "x"}), smaller_pieces(spark, 3):
        sizes.append(spark.conf.get(key))
        1 / 0
    assert sizes == [f"{3 << 20}b"] and spark.conf.get(key) == before and spark.conf.get("spark.tripmart.none", None) is None


def test_the_load_query_shuffles_a_trip_twice_at_most(tmp):
    """Counted in the event log of a session of its own: lines for the join, then dealt by date; the table's rows not at all."""
    log = os.path.join(tmp, "log")
    os.makedirs(log)
    code = f"""
from tripmart.plans.registry import QUERIES
from tripmart.session import build_session
spark = build_session("local[2]", shuffle_partitions=4, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{log}",
    "spark.checkpoint.dir": "{tmp}/ckpt", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}})
print("rows", QUERIES["load_hvfhv"](spark, "{SF}").count(), spark.read.parquet("{SF}/lineitem.parquet").count(), spark.read.parquet("{SF}/orders.parquet").count())
"""
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    said = subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=400, capture_output=True, text=True).stdout
    trips, lines, orders = map(int, said.split("rows ")[1].split())
    shuffled = 0
    for event in (json.loads(line) for file in glob.glob(f"{log}/*") for line in open(file)):
        if event["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in event:
            n = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
            shuffled += n
    # Beside lines, orders and dealt lines: what is counted per file and date, some rows for each of them.
    dates = len(glob.glob(f"{tmp}/ckpt/**/raw-hvfhv-*/pickup_date=*", recursive=True))
    assert trips > lines and 2 * lines <= shuffled < 2 * lines + orders + 5 * dates + 100
