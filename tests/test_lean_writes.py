"""What the writes carry: rows sent again are made behind the join, keys that follow from a row behind the shuffle, nothing is copied twice."""

import glob
import json
import os
import subprocess
import sys

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tripmart.operators import bucketed as B
from tripmart.operators import upsert as U
from tripmart.plans import adapters as A
from tripmart.plans import incremental_marts as I
from tripmart.plans import models as M
from tripmart.plans import registry as R
from tripmart.plans.fact import build_fact, fact_columns, refresh_fact
from tripmart.schemas import SERVICES
from tripmart.session import drop_scratch
from tripmart.sources import sinks
from tripmart.sources.footers import file_footers
from tripmart.sources.load import HASH, stage_files

SF = "/root/testdata/sf0.001"


def _rows(spark, rows):
    return spark.createDataFrame(rows, "v int, d string").select("v", F.col("d").cast("date").alias("pickup_date"))


def _key():
    return {"trip_id": F.md5(F.col("v").cast("string"))}


def _content(df):
    return sorted((r.trip_id, r.v, str(r.pickup_date)) for r in df.collect())


def _scratch(monkeypatch, module):
    made = []
    real = module.scratch_dir
    monkeypatch.setattr(module, "scratch_dir", lambda spark, name: made.append(real(spark, name)) or made[-1])
    return made


def test_lines_are_sent_again_behind_the_join(spark):
    plan = A.line_orders(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join Inner")


def test_a_year_is_one_file_written_without_a_sort(tmp):
    lake, log = os.path.join(tmp, "lake"), os.path.join(tmp, "log")
    os.makedirs(log)
    code = f"""
from tripmart.plans.registry import _put
from tripmart.session import build_session
spark = build_session("local[2]", extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{log}", "spark.checkpoint.dir": "{tmp}/ckpt",
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}})
rows = spark.range(300).selectExpr("cast(1990 + id % 3 AS int) AS year", "id")
_put(spark, rows, "{lake}", [1990, 1992])
_put(spark, rows.selectExpr("year", "-id AS id"), "{lake}", [1992])
_put(spark, rows, "{lake}", [])
"""
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=300)
    got = {os.path.basename(f): sorted(pq.read_table(f).column("id").to_pylist()) for f in glob.glob(f"{lake}/*.parquet")}
    assert got == {"1990.parquet": list(range(0, 300, 3)), "1992.parquet": sorted(-i for i in range(2, 300, 3))}
    nodes = set()
    for event in (json.loads(line) for file in glob.glob(f"{log}/*") for line in open(file)):
        todo = [event["sparkPlanInfo"]] if event.get("sparkPlanInfo") else []
        while todo:
            node = todo.pop()
            todo += node["children"]
            nodes.add(node["nodeName"])
    assert "Exchange" in nodes and "Sort" not in nodes


def test_a_computed_key_gives_the_same_table_and_is_not_copied(spark, tmp, monkeypatch):
    days = ["2026-04-01", "2026-04-02", None]
    first, later = [(i, days[i % 3]) for i in range(60)], [(i, days[i % 3]) for i in range(30, 90, 2)] + [(200, "2026-05-01")]
    for path, computed in ((f"{tmp}/a", None), (f"{tmp}/b", _key())):
        for batch in (first, later):
            df = _rows(spark, batch)
            copied = []
            monkeypatch.setattr(U, "drop_scratch", lambda s, made: copied.append(s.read.parquet(made).columns) or drop_scratch(s, made))
            U.upsert(spark, path, df if computed else df.withColumns(_key()), computed=computed)
    assert copied == [["v", "pickup_date"]]
    table = spark.read.parquet(f"{tmp}/b")
    assert _content(table) == _content(spark.read.parquet(f"{tmp}/a")) and table.columns == ["trip_id", "v", "pickup_date"]
    assert len({r.trip_id for r in table.collect()}) == table.count() == 76  # 60, fifteen new, one of a later date
    plan = U.merged_partitions(table, _rows(spark, later), also=_key()).hint("rebalance", "pickup_date").withColumns(
        {"trip_id": F.when(F.col("_new"), _key()["trip_id"]).otherwise(F.col("trip_id"))})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("md5") < text.index("RebalancePartitions")


def test_a_written_batch_is_not_copied_again_and_a_first_load_not_at_all(spark, tmp, monkeypatch):
    copies, again = _scratch(monkeypatch, I), _scratch(monkeypatch, U)
    fact, states = os.path.join(tmp, "fact"), os.path.join(tmp, "states")
    trips = M.unioned(spark, SF).where("pickup_date >= '1997-12-20' AND pickup_date < '1998-01-01'")
    I.incremental_run(spark, trips, fact, states)
    assert copies == [] and again == []
    assert sorted(map(str, fact_columns(spark.read.parquet(fact)).collect())) == sorted(map(str, fact_columns(build_fact(trips)).collect()))
    I.incremental_run(spark, trips, fact, states)
    assert len(copies) == 1 and again == []
    refresh_fact(spark, trips, fact)
    assert sorted(map(str, fact_columns(spark.read.parquet(fact)).collect())) == sorted(map(str, fact_columns(build_fact(trips)).collect()))


def test_bucketed_upsert_with_a_computed_key(spark, tmp, monkeypatch):
    made, copied = _scratch(monkeypatch, B), []
    monkeypatch.setattr(B, "drop_scratch", lambda s, path: copied.append(s.read.parquet(path).columns) or drop_scratch(s, path))
    schema = spark.createDataFrame([], "trip_id string, v int, pickup_date date").schema
    B.declare(spark, "bucketed_lean", os.path.join(tmp, "t"), schema, 3)
    days = ["2026-04-01", "2026-04-02", None]
    B.upsert_bucketed(spark, "bucketed_lean", _rows(spark, [(i, days[i % 3]) for i in range(60)]), 3, computed=_key())
    assert made == []  # the first batch is the table
    B.upsert_bucketed(spark, "bucketed_lean", _rows(spark, [(i, days[i % 3]) for i in range(30, 90)]), 3, computed=_key())
    assert copied == [["v", "pickup_date"]]
    want = _rows(spark, [(i, days[i % 3]) for i in range(90)]).withColumns(_key())
    assert _content(spark.table("bucketed_lean")) == _content(want)
    assert spark.table("bucketed_lean").where(F.col("trip_id") == F.md5(F.lit("7"))).count() == 1  # found in its bucket


def test_a_plain_load_carries_no_content_hash(spark, tmp):
    sinks.write_partitioned(M.ingested(spark, SF, "yellow").limit(50), os.path.join(tmp, "lake"))
    footers = file_footers(spark, os.path.join(tmp, "lake"))
    plain, files = stage_files(spark, os.path.join(tmp, "lake"), SERVICES["yellow"], footers, hashed=False)
    assert plain.where(F.col(HASH).isNotNull()).isEmpty() and plain.count() == 50
    assert {(r.status, r.content_hash) for r in files.collect()} == {("ok", None)}
    assert files.agg(F.sum("read_rows")).first()[0] == 50


def test_digests_come_from_a_fact_whose_keys_were_added_by_the_writes(spark, monkeypatch):
    written = []
    real = sinks.write_table
    monkeypatch.setattr(R.sinks, "write_table", lambda df, path: written.append(df.columns) or real(df, path))
    assert R.QUERIES["check_unique_incremental"](spark, SF).columns == ["trip_id", "n_records"]
    assert written and "trip_id" not in written[0]
