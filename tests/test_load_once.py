"""The load's single read, the ledger of loaded files, and footers read in tasks."""

import glob
import json
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
from trip_values import ts

from tripmart.plans.load import copy_files, read_ledger, read_table, run_load
from tripmart.sources.footers import file_footers


def _file(path, days, fare=1.0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    at = [ts(f"2026-04-{d:02} 10:00:00") for d in days]
    pq.write_table(pa.table({"VendorID": pa.array([1] * len(at), pa.int32()), "tpep_pickup_datetime": pa.array(at, pa.timestamp("us")),
                             "tpep_dropoff_datetime": pa.array(at, pa.timestamp("us")), "fare_amount": pa.array([fare] * len(at))}), path)


def _rows(spark, table):
    return sorted((r.pickup_date.day, float(r.fare_amount)) for r in read_table(spark, table, "yellow").collect())


def _state(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def test_each_file_is_loaded_once_and_changes_replace_their_own_rows(spark, tmp):
    lake, table, ledger = (os.path.join(tmp, n) for n in ("lake x", "table", "ledger"))
    _file(f"{lake}/a.parquet", [1, 2, 3])
    _file(f"{lake}/b.parquet", [2, 2], 5.0)
    _file(f"{lake}/sub/huge.parquet", [4], 1e12)
    with open(f"{lake}/junk.parquet", "wb") as f:
        f.write(b"no parquet" * 9)
    first = {os.path.basename(r.path): (r.status, r.loaded) for r in copy_files(spark, lake, "yellow", table, ledger).collect()}
    assert first == {"a.parquet": ("ok", True), "b.parquet": ("ok", True), "huge.parquet": ("cast overflow", False), "junk.parquet": ("no rows", False)}
    assert _rows(spark, table) == [(1, 1.0), (2, 1.0), (2, 5.0), (2, 5.0), (3, 1.0)]

    state = _state(table), _state(ledger)
    assert copy_files(spark, lake, "yellow", table, ledger).collect() == []
    assert (_state(table), _state(ledger)) == state, "a run without new files writes nothing"

    _file(f"{lake}/c.parquet", [2, 9], 7.0)
    assert [os.path.basename(r.path) for r in copy_files(spark, lake, "yellow", table, ledger).collect()] == ["c.parquet"]
    assert _rows(spark, table) == [(1, 1.0), (2, 1.0), (2, 5.0), (2, 5.0), (2, 7.0), (3, 1.0), (9, 7.0)]

    time.sleep(1.1)
    _file(f"{lake}/a.parquet", [1, 6], 2.0)          # corrected: days 2 and 3 go, day 3 has no other rows
    os.utime(f"{lake}/b.parquet")                    # delivered again
    _file(f"{lake}/sub/huge.parquet", [4], 3.0)      # mended
    got = {os.path.basename(r.path): r.status for r in copy_files(spark, lake, "yellow", table, ledger).collect()}
    assert got == {"a.parquet": "ok", "b.parquet": "unchanged", "huge.parquet": "ok"}
    assert _rows(spark, table) == [(1, 2.0), (2, 5.0), (2, 5.0), (2, 7.0), (4, 3.0), (6, 2.0), (9, 7.0)]
    entries = {os.path.basename(r.path): (r.load_id, r.status, r.read_rows) for r in read_ledger(spark, ledger).collect()}
    assert entries == {"a.parquet": (3, "ok", 2), "b.parquet": (3, "unchanged", 2), "c.parquet": (2, "ok", 2),
                       "huge.parquet": (3, "ok", 1), "junk.parquet": (1, "no rows", None)}

    time.sleep(1.1)
    _file(f"{lake}/c.parquet", [9], 1e12)            # a change that can't be loaded: its rows stay
    assert [(r.status, r.loaded) for r in copy_files(spark, lake, "yellow", table, ledger).collect()] == [("cast overflow", False)]
    assert _rows(spark, table)[-1] == (9, 7.0)


def test_a_load_cut_short_before_its_ledger_entry_is_done_again(spark, tmp):
    lake, table, ledger = (os.path.join(tmp, n) for n in ("lake", "table", "ledger"))
    _file(f"{lake}/a.parquet", [1, 2])
    copy_files(spark, lake, "yellow", table, ledger)
    _file(f"{lake}/b.parquet", [2, 3], 4.0)
    copy_files(spark, lake, "yellow", table, os.path.join(tmp, "lost"))  # its entries never reached the ledger
    assert len(copy_files(spark, lake, "yellow", table, ledger).collect()) == 1
    assert _rows(spark, table) == [(1, 1.0), (2, 1.0), (2, 4.0), (3, 4.0)]


def test_the_load_reads_the_lake_once(tmp):
    """Counted in the event log of a session of its own: rows that scans of the lake gave."""
    import subprocess
    import sys
    lake, log = os.path.join(tmp, "lake"), os.path.join(tmp, "log")
    os.makedirs(log)
    for i in range(6):
        _file(f"{lake}/{i}.parquet", [1, 2, 3, 4, 5])
    code = f"""
from tripmart.plans.load import run_load
from tripmart.session import build_session
spark = build_session("local[2]", extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{log}", "spark.checkpoint.dir": "{tmp}/ckpt",
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}})
assert [r.loaded for r in run_load(spark, "{lake}", "yellow", "{tmp}/table").collect()] == [True] * 6
assert spark.read.parquet("{tmp}/table").count() == 30
"""
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=300)
    scans = 0
    for file in glob.glob(f"{log}/*"):
        for event in map(json.loads, open(file)):
            todo = [event.get("sparkPlanInfo")] if event.get("Event", "").endswith("SparkListenerSQLExecutionStart") else []
            while todo:
                node = todo.pop()
                todo += node["children"]
                place = node["metadata"].get("Location", "")
                scans += node["nodeName"].startswith("Scan parquet") and f"{lake}" in place
    assert scans == 1


def test_footers_of_odd_files_and_of_stores_that_arrow_cannot_open(spark, tmp):
    root = os.path.join(tmp, "100% a b")
    _file(f"{root}/x/good one.parquet", [1, 2])
    pq.write_table(pa.table({"fare_amount": pa.array([1], pa.int32()), "at": pa.array([None], pa.timestamp("ns")),
                             "zone": pa.array([["a"]]), "n": pa.array([1], pa.uint8())}),
                   f"{root}/odd.parquet", use_deprecated_int96_timestamps=True)
    with open(f"{root}/junk.parquet", "w") as f:
        f.write("junk")
    got = {os.path.basename(r.path): r for r in file_footers(spark, root).collect()}
    assert {k: r.rows for k, r in got.items()} == {"good%20one.parquet": 2, "odd.parquet": 1, "junk.parquet": None}
    assert got["junk.parquet"].error and got["junk.parquet"].columns is None
    types = {c.name: c.type for c in got["odd.parquet"].columns}
    assert types["fare_amount"] == "int" and types["at"] == "timestamp" and types["zone"] == "array<string>"
    assert {c.name: c.type for c in got["good%20one.parquet"].columns}["tpep_pickup_datetime"] == "timestamp_ntz"
    from tripmart.sources import footers
    opened, footers.OPENED = footers.OPENED, ()  # as for a store that only Hadoop's file systems reach
    try:
        other = {os.path.basename(r.path): r for r in file_footers(spark, root).collect()}
    finally:
        footers.OPENED = opened
    assert {k: (r.rows, r.columns) for k, r in other.items()} == {k: (r.rows, r.columns) for k, r in got.items()}
