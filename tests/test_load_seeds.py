"""By-name load with bad-file report (S6-S8, P10, K6), seeds (S5), schema
report (S9), partitioned write modes (K1)."""

import os
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
from trip_values import ts

from tripmart.schemas import YELLOW
from tripmart.sources import load as L
from tripmart.sources.scan import read_partitioned, schema_report
from tripmart.sources.seeds import length_violations, read_seed
from tripmart.sources.sinks import write_partitioned


def _yellow_file(path, n=3, fare=2.675, upper=False, extra_order=False, ptype=pa.int64()):
    cols = {
        "VendorID": pa.array([1] * n, pa.int32()),
        "tpep_pickup_datetime": pa.array([ts("2026-04-10 10:00:00")] * n, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([ts("2026-04-10 10:30:00")] * n, pa.timestamp("us")),
        "passenger_count": pa.array(["1" if ptype == pa.string() else 1] * n, ptype),
        "fare_amount": pa.array([fare] * n, pa.float64()),
        "trip_duration_minutes": pa.array([30] * n, pa.int64()),
    }
    names = list(cols)
    if extra_order:
        names = names[::-1]
    t = pa.table({(k.upper() if upper else k): cols[k] for k in names})
    pq.write_table(t, path)


def test_load_by_name_and_bad_files(spark, tmp):
    root = os.path.join(tmp, "yellow")
    os.makedirs(root)
    _yellow_file(os.path.join(root, "a.parquet"))
    _yellow_file(os.path.join(root, "b.parquet"), upper=True, extra_order=True, fare=1.0)
    _yellow_file(os.path.join(root, "mismatch.parquet"), ptype=pa.string())
    _yellow_file(os.path.join(root, "empty.parquet"), n=0)
    with open(os.path.join(root, "junk.parquet"), "wb") as f:
        f.write(b"not a parquet file at all" * 10)
    with open(os.path.join(root, "notes.txt"), "w") as f:
        f.write("ignored by the pattern")

    schema = YELLOW.table
    health = {os.path.basename(r.path): r.status for r in
              L.file_health(spark, root, _probe_schema(schema)).collect()}
    assert health == {"a.parquet": "ok", "b.parquet": "ok", "mismatch.parquet": "unreadable",
                      "empty.parquet": "no rows", "junk.parquet": "no rows"}

    df = L.load_raw(spark, root, YELLOW, skip_bad_files=True)
    rows = df.collect()
    assert len(rows) == 6
    assert df.schema["fare_amount"].dataType.simpleString() == "decimal(10,2)"
    assert sorted({r.fare_amount for r in rows}) == [Decimal("1.00"), Decimal("2.68")]
    assert all(r.trip_distance is None for r in rows)                 # absent column -> NULL
    assert all(str(r.pickup_date) == "2026-04-10" for r in rows)      # back-filled
    assert df.schema["trip_duration_minutes"].dataType.simpleString() == "int"


def _probe_schema(table_schema):
    from pyspark.sql.types import StructType
    from tripmart.schemas import YELLOW_RAW
    keep = {"VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "fare_amount"}
    return StructType([f for f in YELLOW_RAW.fields if f.name in keep])


def test_partitioned_write_dynamic_and_static(spark, tmp):
    path = os.path.join(tmp, "p")
    a = spark.createDataFrame([(1, ts("2026-04-01 00:00:00").date()), (2, ts("2026-04-02 00:00:00").date())],
                              "x int, pickup_date date")
    write_partitioned(a, path)
    b = spark.createDataFrame([(3, ts("2026-04-02 00:00:00").date())], "x int, pickup_date date")
    write_partitioned(b, path)                                    # dynamic: day 1 survives
    assert sorted(r.x for r in read_partitioned(spark, path).collect()) == [1, 3]
    write_partitioned(b, path, overwrite_scope="static")          # static: whole dataset replaced
    assert sorted(r.x for r in read_partitioned(spark, path).collect()) == [3]
    assert read_partitioned(spark, path).schema["pickup_date"].dataType.simpleString() == "date"


def test_seed_csv(spark, tmp):
    p = os.path.join(tmp, "zones.csv")
    with open(p, "w") as f:
        f.write('"LocationID","Borough","Zone","service_zone"\n1,"EWR","N/A","EWR"\n2,"Queens","","Boro Zone"\n'
                '3,"Queens","Same","Boro Zone"\n4,"Bronx","Same","Boro Zone"\n')
    z = {r.LocationID: r for r in read_seed(spark, p, "taxi_zone_lookup").collect()}
    assert z[1].Zone == "N/A" and z[2].Zone is None and z[3].Zone == z[4].Zone == "Same"
    b = os.path.join(tmp, "bases.csv")
    with open(b, "w") as f:
        f.write("hvfhs_license_num,base_name,base_type\nHV0003,Uber,App-based\nHV00031,Too long,App-based\n")
    assert [r.hvfhs_license_num for r in length_violations(read_seed(spark, b, "hvfhv_bases"), "hvfhv_bases").collect()] == ["HV00031"]


def test_schema_report(spark, tmp):
    root = os.path.join(tmp, "y")
    os.makedirs(root)
    _yellow_file(os.path.join(root, "a.parquet"))
    rep = {r.column_name.lower(): r.status for r in schema_report(spark, root, YELLOW.table).collect()}
    assert rep["fare_amount"] == "type differs"          # double in files, decimal(10,2) declared
    assert rep["vendorid"] == "ok"
    assert rep["trip_distance"] == "missing in files"


def test_half_corrupt_file_is_skipped_whole(spark, tmp):
    """A file whose second row group is damaged: with ignoreCorruptFiles Spark
    would keep the first row group; the probe sees fewer rows read than the
    footer declares and the load skips the whole file."""
    root = os.path.join(tmp, "half")
    os.makedirs(root)
    n = 20000
    t = pa.table({"VendorID": pa.array([1] * n, pa.int32()),
                  "tpep_pickup_datetime": pa.array([ts("2026-04-10 10:00:00")] * n, pa.timestamp("us")),
                  "fare_amount": pa.array([float(i) for i in range(n)], pa.float64())})
    bad = os.path.join(root, "half.parquet")
    pq.write_table(t, bad, row_group_size=n // 2, compression="snappy", use_dictionary=False)
    _yellow_file(os.path.join(root, "good.parquet"))
    meta = pq.ParquetFile(bad).metadata
    col = meta.row_group(1).column(2)
    start = col.data_page_offset
    with open(bad, "r+b") as f:              # overwrite the middle of row group 2's fare pages
        f.seek(start + 64)
        f.write(b"\xff" * 2048)
    health = {os.path.basename(r.path): (r.status, r.footer_rows, r.read_rows)
              for r in L.file_health(spark, root, _probe_schema(YELLOW.table)).collect()}
    assert health["good.parquet"][0] == "ok"
    assert health["half.parquet"][0] in ("partly unreadable", "unreadable")
    assert health["half.parquet"][1] == n
    loaded = L.load_raw(spark, root, YELLOW, skip_bad_files=True)
    assert loaded.count() == 3


def test_cast_overflow_file_is_skipped_and_reported(spark, tmp):
    root = os.path.join(tmp, "ovf")
    os.makedirs(root)
    _yellow_file(os.path.join(root, "ok.parquet"))
    _yellow_file(os.path.join(root, "huge.parquet"), fare=1e12)      # does not fit decimal(10,2)
    from tripmart.schemas import lake_schema
    health = {os.path.basename(r.path): (r.status, r.cast_failures) for r in
              L.file_health(spark, root, lake_schema(YELLOW), target=YELLOW.table).collect()}
    assert health == {"ok.parquet": ("ok", 0), "huge.parquet": ("cast overflow", 3)}
    assert L.load_raw(spark, root, YELLOW, skip_bad_files=True).count() == 3


def test_odd_folder_names_and_nested_files(spark, tmp):
    """Spaces, percent signs and escaped partition values in paths, and files in sub-folders:
    every listed file is loaded, and the report says so."""
    from tripmart.plans.load import run_load
    root = os.path.join(tmp, "a b", "100% lake")
    folders = ["", "x y", "50%", "pickup_date=2026-04-11", "2026/04", "pickup_date=__HIVE_DEFAULT_PARTITION__", "p=a%3Ab"]
    for i, f in enumerate(folders):
        os.makedirs(os.path.join(root, f), exist_ok=True)
        _yellow_file(os.path.join(root, f, f"f {i}%.parquet"))
    _yellow_file(os.path.join(root, "x y", "too big.parquet"), fare=1e12)
    table = os.path.join(tmp, "table")
    report = {os.path.basename(r.path): (r.status, r.loaded) for r in run_load(spark, root, "yellow", table).collect()}
    assert len(report) == len(folders) + 1
    assert [k for k, v in report.items() if v != ("ok", True)] == ["too%20big.parquet"]
    assert report["too%20big.parquet"] == ("cast overflow", False)
    rows = spark.read.parquet(table).collect()
    assert len(rows) == 3 * len(folders)
    assert sorted({str(r.pickup_date) for r in rows}) == ["2026-04-10", "2026-04-11"]


def test_schema_report_covers_all_files(spark, tmp):
    root = os.path.join(tmp, "y")
    os.makedirs(os.path.join(root, "sub"))
    for i in range(3):
        _yellow_file(os.path.join(root, f"a{i}.parquet"))
    pq.write_table(pa.table({"fare_amount": pa.array(["x"]), "surge": pa.array([1.0])}), os.path.join(root, "sub", "z.parquet"))
    rep = {r.column_name.lower(): (r.type, r.status) for r in schema_report(spark, root, YELLOW.table).collect()}
    assert rep["fare_amount"] == ("double, string", "type differs") and rep["surge"] == ("double", "not declared")
    assert rep["vendorid"] == ("int", "ok")


def test_post_load_check(spark, tmp):
    root = os.path.join(tmp, "plc")
    os.makedirs(root)
    _yellow_file(os.path.join(root, "a.parquet"))
    _yellow_file(os.path.join(root, "b.parquet"), n=4)
    r = L.post_load_check(spark, root, YELLOW.table).first()
    assert r.rows == 7 and r.columns_in_files == 6
    assert r.columns_type_differs == 2        # fare double vs decimal, duration bigint vs int
    assert r.columns_missing == len(YELLOW.table.fields) - 6
