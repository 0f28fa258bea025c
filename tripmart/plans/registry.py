"""Registered queries over the driver tables, each with its SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``
(DuckDB SQL over the pre-registered driver-table views). Queries without an
oracle entry are checked by row count only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.plans import marts
from tripmart.plans import models as M
from tripmart.plans import sql_twins as Q
from tripmart.plans.adapters import ZONES_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- Q1-Q4 ingest --------------------------------------------------------------

# The window cuts the first and last months of the given tables and keeps most rows.
START, END = dt.datetime(1995, 3, 1), dt.datetime(2001, 6, 1)
EVENTS_START, EVENTS_END = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 28)


def _ingest(name: str, service: str, start: dt.datetime, end: dt.datetime) -> None:
    def run(spark, sf):
        return M.ingested(spark, sf, service, split=False, start=start, end=end)

    run.__name__ = name
    run.__doc__ = f"Q1-Q4: the {service} job with its pickup-time window (F2/F3)."
    register(name, f"SELECT * FROM {Q.ingest_sql(service, start=start.isoformat(sep=' '), end=end.isoformat(sep=' '), split=False)}")(run)


_ingest("ingest_taxi", "yellow", START, END)
_ingest("ingest_green", "green", START, END)
_ingest("ingest_fhv", "fhv", EVENTS_START, EVENTS_END)
_ingest("ingest_hvfhv", "hvfhv", START, END)


# --- Q9 fact, Q10-Q12 marts -------------------------------------------------------

@register("fact_full", f"SELECT * FROM {Q.fact_sql(Q.union_sql())}")
def fact_full(spark, sf):
    return M.fact(spark, sf)


@register("mart_daily_summary", Q.daily_summary_sql(Q.fact_sql(Q.union_sql())))
def mart_daily_summary(spark, sf):
    return marts.daily_summary(M.fact(spark, sf))


@register("mart_revenue_breakdown", Q.revenue_breakdown_sql(Q.fact_sql(Q.union_sql())))
def mart_revenue_breakdown(spark, sf):
    return marts.revenue_breakdown(M.fact(spark, sf))


@register("mart_zone_performance", Q.zone_performance_sql(Q.fact_sql(Q.union_sql()), ZONES_SQL))
def mart_zone_performance(spark, sf):
    return marts.zone_performance(M.fact(spark, sf), M.zone_dim(spark, sf))


# --- scans, sources, sinks (S1-S12, K1-K7) ----------------------------------------------

import os  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from tripmart.operators import filters as flt  # noqa: E402
from tripmart.operators import bucketed, layout, quality  # noqa: E402
from tripmart.operators.dedup import dedup_latest  # noqa: E402
from tripmart.operators.unique_digests import duplicated_keys  # noqa: E402
from tripmart.operators.upsert import high_water_mark  # noqa: E402
from tripmart.plans import adapters as A  # noqa: E402
from tripmart.plans import fact as fact_plan  # noqa: E402
from tripmart.plans import incremental_marts as kept_marts  # noqa: E402
from tripmart.plans import load as load_plan  # noqa: E402
from tripmart.plans import publish as publish_plan  # noqa: E402
from tripmart.plans.ingest import run_ingest  # noqa: E402
from tripmart.plans.load import run_load  # noqa: E402
from tripmart.functions import expressions as X  # noqa: E402
from tripmart.schemas import FACT, SERVICES, TRIP_KEY  # noqa: E402
from tripmart.session import scratch_dir, shuffles_freed, smaller_pieces  # noqa: E402
from tripmart.sources import load as L  # noqa: E402
from tripmart.sources import scan, seeds, sinks  # noqa: E402

DECLARED_ORDERS = ("O_ORDERKEY bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
                   "o_totalprice double, o_comment string")


@register("scan_declared_schema",
          "SELECT o_orderkey AS O_ORDERKEY, o_custkey, o_orderdate, o_totalprice, "
          "CAST(NULL AS VARCHAR) AS o_comment FROM orders")
def scan_declared_schema(spark, sf):
    """Declared schema, case-insensitive names, absent column NULL."""
    return scan.read_trips(spark, f"{sf}/orders.parquet", DECLARED_ORDERS)


def _written_yellow(spark, sf, partitioned=True) -> str:
    """Ingest yellow (whole lineitem) and write it as the job does (K1)."""
    out = scratch_dir(spark, "yellow")
    df = M.ingested(spark, sf, "yellow", split=False)
    if partitioned:
        sinks.write_partitioned(df, out, "pickup_date")
    else:
        sinks.write_table(df.drop("pickup_date"), out)
    return out


_YELLOW_INGEST = Q.ingest_sql("yellow", split=False)


@register("scan_partitioned_roundtrip", f"SELECT * FROM {_YELLOW_INGEST}")
def scan_partitioned_roundtrip(spark, sf):
    """K1 + S4 + S7: partitioned write, read back with partition discovery."""
    path = _written_yellow(spark, sf)
    back = scan.read_partitioned(spark, path)
    cols = M.ingested(spark, sf, "yellow", split=False).columns
    return back.select(*cols)


def _load(name: str, service: str) -> None:
    def run(spark, sf):
        lake, table = scratch_dir(spark, f"lake-{service}"), scratch_dir(spark, f"raw-{service}")
        trips = M.ingested(spark, sf, service, split=False, by_date=True)
        with shuffles_freed(spark), smaller_pieces(spark, 3):  # a row grows to three times its bytes behind the shuffle
            sinks.write_partitioned(trips, lake, "pickup_date", rebalance=False)
        run_load(spark, lake, service, table)
        return spark.read.parquet(table).select(*[f.name for f in SERVICES[service].table.fields])

    run.__name__ = name
    run.__doc__ = f"""Q5/K2: the {service} lake loaded by column name into its typed raw table (S6-S8, P10, K6),
    created or replaced, with the bad-file probe on."""
    register(name, f"SELECT * FROM {Q.table_sql(service, Q.ingest_sql(service, split=False))}")(run)


_load("load_by_name_cast", "yellow")
_load("load_green", "green")
_load("load_fhv", "fhv")
_load("load_hvfhv", "hvfhv")


@register("backfill_date", f"SELECT * FROM {Q.table_sql('yellow', _YELLOW_INGEST)}")
def backfill_date(spark, sf):
    """K6: files written without the partition column load with NULL
    pickup_date, back-filled from the pickup timestamp."""
    return L.load_raw(spark, _written_yellow(spark, sf, partitioned=False), SERVICES["yellow"])


def _plant_bad_files(spark, root: str) -> None:
    """A nested file with a fare that overflows the table's decimal, a nested file without rows,
    and one that is no Parquet at all."""
    one = spark.createDataFrame([(1, 1e12)], "VendorID int, fare_amount double")
    one.coalesce(1).write.mode("append").parquet(f"{root}/late files/100%")
    one.where("VendorID > 1").coalesce(1).write.mode("append").parquet(f"{root}/late files/empty")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/late files/junk.parquet")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(b"no parquet file" * 20))
    out.close()


@register("file_health",
          f"SELECT 'ok' AS status, COUNT(*) AS rows, TRUE AS loaded FROM {_YELLOW_INGEST} UNION ALL "
          "SELECT 'cast overflow', 1, FALSE UNION ALL SELECT 'no rows', 0, FALSE")
def file_health(spark, sf):
    """The load's report by status, over the written lake with planted bad files in a
    sub-folder: rows the files hold, and whether they were loaded."""
    lake = _written_yellow(spark, sf)
    _plant_bad_files(spark, lake)
    report = run_load(spark, lake, "yellow", scratch_dir(spark, "raw-yellow"))
    return report.groupBy("status").agg(F.coalesce(F.sum("footer_rows"), F.lit(0)).cast("bigint").alias("rows"),
                                        F.bool_and("loaded").alias("loaded"))


@register("load_skips_bad_files", f"SELECT * FROM {Q.table_sql('yellow', _YELLOW_INGEST)}")
def load_skips_bad_files(spark, sf):
    """The same lake loaded; no row of a good file is lost, none of a bad file gets in."""
    lake = _written_yellow(spark, sf)
    _plant_bad_files(spark, lake)
    return L.load_raw(spark, lake, SERVICES["yellow"], skip_bad_files=True)


def _put(spark, rows, lake: str, names: list[int]) -> None:
    """Write ``rows`` (with a column ``year``) as one file per year, under a name of its own, over what is there. Each year
    has a task of its own that writes its rows as they come: no sort, so the task's memory does not grow with the year."""
    if not names:
        return
    made = scratch_dir(spark, "delivery")
    place = F.array_position(F.array(*map(F.lit, names)), F.col("year")).cast("int") - 1
    sinks.write_table(rows.where(F.col("year").isin(names)).repartitionById(len(names), place).drop("year"), made)
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path(lake))
    for f in store.globStatus(path(f"{made}/part-*.parquet")) or []:
        name = names[int(f.getPath().getName().split("-")[1])]
        store.delete(path(f"{lake}/{name}.parquet"), False)
        store.rename(f.getPath(), path(f"{lake}/{name}.parquet"))


_LOADED_YEARS = "EXTRACT(year FROM tpep_pickup_datetime)"


def _ledger_loads(spark, sf) -> tuple[str, str]:
    """A lake of one file per year, loaded in three runs: the years up to 1995; then the later years, with 1994 corrected
    (every fare a dollar higher) and 1993 delivered again as it was; then nothing new."""
    lake, table, ledger = (scratch_dir(spark, n) for n in ("lake-ledger", "raw-ledger", "ledger"))
    rows = M.ingested(spark, sf, "yellow", split=False).drop("pickup_date").withColumn("year", F.year("tpep_pickup_datetime"))
    years = sorted(r[0] for r in rows.select("year").distinct().collect())
    _put(spark, rows.where("year <= 1995"), lake, [y for y in years if y <= 1995])
    load_plan.copy_files(spark, lake, "yellow", table, ledger)
    _put(spark, rows.where("year > 1995"), lake, [y for y in years if y > 1995])
    _put(spark, rows.where("year = 1994").withColumn("fare_amount", F.col("fare_amount") + 1), lake, [y for y in years if y == 1994])
    _touch(spark, f"{lake}/1993.parquet")
    load_plan.copy_files(spark, lake, "yellow", table, ledger)
    load_plan.copy_files(spark, lake, "yellow", table, ledger)
    return table, ledger


def _touch(spark, file: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(path):
        store.setTimes(path, store.getFileStatus(path).getModificationTime() + 5000, -1)


@register("load_ledger_table", f"""SELECT * REPLACE (CASE WHEN {_LOADED_YEARS} = 1994 THEN CAST(fare_amount + 1 AS DECIMAL(10,2))
    ELSE fare_amount END AS fare_amount) FROM {Q.table_sql('yellow', _YELLOW_INGEST)}""")
def load_ledger_table(spark, sf):
    """Each file loaded once over three runs; the corrected file replaced its own rows."""
    return load_plan.read_table(spark, _ledger_loads(spark, sf)[0], "yellow")


@register("load_ledger", f"""SELECT CAST({_LOADED_YEARS} AS VARCHAR) || '.parquet' AS file, COUNT(*) AS rows,
    CASE WHEN {_LOADED_YEARS} <= 1992 OR {_LOADED_YEARS} = 1995 THEN 1 ELSE 2 END AS load_id,
    CASE WHEN {_LOADED_YEARS} = 1993 THEN 'unchanged' ELSE 'ok' END AS status FROM {_YELLOW_INGEST} GROUP BY {_LOADED_YEARS}""")
def load_ledger(spark, sf):
    """What the ledger says of every file after the three runs (the third wrote no entry)."""
    return load_plan.read_ledger(spark, _ledger_loads(spark, sf)[1]).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("read_rows").alias("rows"), F.col("load_id").cast("int"), "status")


@register("seed_csv_roundtrip", f"SELECT * FROM {A.ZONES_SQL}")
def seed_csv_roundtrip(spark, sf):
    """The zone lookup written as a header CSV seed and read back
    with the seed's declared types."""
    path = scratch_dir(spark, "seed")
    A.zones(spark, sf).write.option("header", True).csv(path)
    return seeds.read_seed(spark, path, "taxi_zone_lookup")


# What the yellow job writes, against the declared table.
_YELLOW_REPORT = [
    ("VendorID", "int", "int", "ok"), ("tpep_pickup_datetime", "timestamp_ntz", "timestamp_ntz", "ok"),
    ("tpep_dropoff_datetime", "timestamp_ntz", "timestamp_ntz", "ok"), ("passenger_count", "bigint", "bigint", "ok"),
    ("trip_distance", "double", "decimal(10,2)", "type differs"), ("RatecodeID", "bigint", "bigint", "ok"),
    ("store_and_fwd_flag", "string", "string", "ok"), ("PULocationID", "int", "int", "ok"), ("DOLocationID", "int", "int", "ok"),
    ("payment_type", "bigint", "bigint", "ok"), ("fare_amount", "double", "decimal(10,2)", "type differs"),
    ("extra", "double", "decimal(10,2)", "type differs"), ("mta_tax", "double", "decimal(10,2)", "type differs"),
    ("tip_amount", "double, string", "decimal(10,2)", "type differs"), ("tolls_amount", "double", "decimal(10,2)", "type differs"),
    ("improvement_surcharge", "double", "decimal(10,2)", "type differs"),
    ("total_amount", "double", "decimal(10,2)", "type differs"),
    ("congestion_surcharge", "double", "decimal(10,2)", "type differs"),
    ("airport_fee", "double", "decimal(10,2)", "type differs"), ("cbd_congestion_fee", "double", "decimal(10,2)", "type differs"),
    ("trip_duration_minutes", "bigint", "int", "type differs"), ("avg_speed_mph", "double", "decimal(10,2)", "type differs"),
    ("source_file", "string", "string", "ok"), ("ingested_at_timestamp", "timestamp_ntz", "timestamp_ntz", "ok"),
    ("pickup_date", None, "date", "missing in files"), ("surge", "double", None, "not declared")]


@register("schema_report", "SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join("CAST(NULL AS VARCHAR)" if v is None else f"'{v}'" for v in r) + ")" for r in _YELLOW_REPORT)
    + ") AS t(column_name, type, declared_type, status)")
def schema_report(spark, sf):
    """Columns and types in all written files against the raw-table DDL; one more file has a
    tip that is text and a column of its own."""
    root = _written_yellow(spark, sf)
    odd = spark.createDataFrame([("none", 1.5)], "tip_amount string, surge double")
    odd.coalesce(1).write.mode("append").parquet(f"{root}/odd")
    return scan.schema_report(spark, root, SERVICES["yellow"].table)


@register("preview_rows",
          f"SELECT * FROM {A.taxi_raw_sql('yellow')} ORDER BY tpep_pickup_datetime, PULocationID, "
          "DOLocationID, fare_amount LIMIT 5")
def preview_rows(spark, sf):
    """L1: first rows in a stated order (a top-n, no full sort)."""
    return layout.preview(A.taxi_raw(spark, sf, "yellow"), 5,
                          ["tpep_pickup_datetime", "PULocationID", "DOLocationID", "fare_amount"])


@register("partition_skew", f"SELECT COUNT(*) AS rows, TRUE AS max_covers_mean, TRUE AS has_partitions FROM {A.taxi_raw_sql('yellow')}")
def partition_skew(spark, sf):
    """L2: the skew report of the trip scan, in figures that don't depend on the partitioning."""
    skew = layout.partition_skew(A.taxi_raw(spark, sf, "yellow", None))
    return skew.select("rows", (F.col("max_rows") >= F.col("mean_rows")).alias("max_covers_mean"),
                       (F.col("partitions") > 0).alias("has_partitions"))


_LAYOUTS = {"even": "o_orderkey % 4", "skewed": "CASE WHEN o_orderkey % 10 < 7 THEN 0 ELSE o_orderkey % 10 - 6 END"}


@register("partition_skew_planted", " UNION ALL ".join(
    f"SELECT '{name}' AS layout, COUNT(*) AS partitions, CAST(SUM(n) AS BIGINT) AS rows, MAX(n) AS max_rows, AVG(n) AS mean_rows "
    f"FROM (SELECT COUNT(*) AS n FROM orders GROUP BY {part})" for name, part in _LAYOUTS.items()))
def partition_skew_planted(spark, sf):
    """L2 on two layouts of known partitions: the skewed one has 70 % of the orders in one partition."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
    out = [layout.partition_skew(orders.repartitionById(4, F.expr(f"cast({part} AS INT)"))).select(F.lit(name).alias("layout"), "*")
           for name, part in _LAYOUTS.items()]
    return out[0].union(out[1])


# --- projections, union, dims (P1-P11, U1, Q6-Q8) ----------------------------------------

@register("stage_rename_tag", f"SELECT * FROM {Q.service_staged_sql('green', split=False)}")
def stage_rename_tag(spark, sf):
    """Green staging (renames, trip_type tag, trip_type->green_trip_type)."""
    return M.staged(spark, sf, "green", split=False)


@register("stage_fhv", f"SELECT * FROM {Q.service_staged_sql('fhv', split=False)}")
def stage_fhv(spark, sf):
    return M.staged(spark, sf, "fhv", split=False)


@register("stage_hvfhv", f"SELECT * FROM {Q.service_staged_sql('hvfhv', split=False)}")
def stage_hvfhv(spark, sf):
    return M.staged(spark, sf, "hvfhv", split=False)


@register("stage_yellow", f"SELECT * FROM {Q.service_staged_sql('yellow', split=False)}")
def stage_yellow(spark, sf):
    return M.staged(spark, sf, "yellow", split=False)


@register("union_padded", f"SELECT * FROM {Q.union_sql()}")
def union_padded(spark, sf):
    """Three services aligned to 32 columns, UNION ALL."""
    return M.unioned(spark, sf)


@register("dim_passthrough", f"SELECT * FROM {A.ZONES_SQL}")
def dim_passthrough(spark, sf):
    """dimension = SELECT * of its seed."""
    from tripmart.operators.projections import passthrough
    return passthrough(A.zones(spark, sf))


@register("except_column", f"SELECT * EXCLUDE (row_num) FROM {Q.ranked_sql(Q.union_sql())} WHERE row_num = 1")
def except_column(spark, sf):
    """W1/F10/P9 in the literal ROW_NUMBER form: rank, keep 1, drop row_num."""
    ranked = dedup_latest(M.unioned(spark, sf), TRIP_KEY, "ingestion_timestamp",
                                 fact_plan.TIE_BREAKERS, keep_rank=True)
    return ranked.drop("row_num")


# --- filters (F1-F11) -----------------------------------------------------------------

_T_ALL = A.taxi_raw_sql("yellow")


@register("drop_cash_tip",
          f"SELECT * FROM {_T_ALL} WHERE NOT (payment_type = 2 AND CAST(tip_amount AS DECIMAL(10,0)) > 0)")
def drop_cash_tip(spark, sf):
    return flt.drop_cash_tip(A.taxi_raw(spark, sf, "yellow"))


@register("month_window",
          f"SELECT * FROM {_T_ALL} WHERE tpep_pickup_datetime >= TIMESTAMP '1998-03-01' "
          "AND tpep_pickup_datetime < TIMESTAMP '1998-04-01'")
def month_window(spark, sf):
    """F2/F3 for target month 1998-03 as a pushed-down half-open range."""
    return flt.month_window(A.taxi_raw(spark, sf, "yellow"), "tpep_pickup_datetime", "1998-03")


@register("drop_zero_count", f"SELECT * FROM {_T_ALL} WHERE passenger_count <> 0")
def drop_zero_count(spark, sf):
    return flt.drop_zero(A.taxi_raw(spark, sf, "yellow"), "passenger_count")


@register("positive_fare", f"SELECT *, fare_amount - 1000 AS net_fare FROM {_T_ALL} WHERE fare_amount - 1000 > 0")
def positive_fare(spark, sf):
    """F5 on the fare net of a 1000 deduction (so the filter bites)."""
    raw = A.taxi_raw(spark, sf, "yellow").withColumn("net_fare", F.col("fare_amount") - 1000)
    return flt.positive(raw, "net_fare")


_FHV = A.fhv_raw_sql()


@register("drop_both_null", f"SELECT * FROM {_FHV} WHERE NOT (PUlocationID IS NULL AND DOlocationID IS NULL)")
def drop_both_null(spark, sf):
    return flt.drop_both_null(A.fhv_raw(spark, sf), "PUlocationID", "DOlocationID")


@register("drop_zero_minutes",
          f"SELECT * FROM {_FHV} WHERE NOT (date_sub('minute', pickup_datetime, dropOff_datetime) = 0)")
def drop_zero_minutes(spark, sf):
    return flt.drop_zero_minute_trips(A.fhv_raw(spark, sf), "pickup_datetime", "dropOff_datetime")


@register("conditional_equal_time",
          f"SELECT * FROM {_FHV} WHERE NOT (pickup_datetime = dropOff_datetime) "
          f"OR NOT EXISTS (SELECT 1 FROM {_FHV} WHERE pickup_datetime >= dropOff_datetime)")
def conditional_equal_time(spark, sf):
    """drop pickup == dropoff only if any pickup >= dropoff exists (a
    scalar EXISTS subquery, evaluated once, not a driver-side branch)."""
    raw = A.fhv_raw(spark, sf)
    any_bad = raw.where(F.col("pickup_datetime") >= F.col("dropOff_datetime")).exists()
    return raw.where(~flt.equal_time_predicate("pickup_datetime", "dropOff_datetime") | ~any_bad)


@register("is_null_filter", f"SELECT * FROM {_FHV} WHERE SR_Flag IS NULL")
def is_null_filter(spark, sf):
    """F11."""
    return flt.is_null(A.fhv_raw(spark, sf), "SR_Flag")


# --- expressions (X1-X15) ----------------------------------------------------------------

@register("duration_minutes",
          f"SELECT pickup_datetime, dropOff_datetime, date_sub('minute', pickup_datetime, dropOff_datetime) "
          f"AS trip_duration_minutes, strftime(pickup_datetime, '%Y-%m') AS pickup_month, "
          f"CAST(pickup_datetime AS DATE) AS pickup_date FROM {_FHV}")
def duration_minutes(spark, sf):
    """X1/X2/X3 on sub-minute trips."""
    raw = A.fhv_raw(spark, sf)
    return raw.select("pickup_datetime", "dropOff_datetime",
                      X.duration_minutes("pickup_datetime", "dropOff_datetime").alias("trip_duration_minutes"),
                      X.year_month("pickup_datetime").alias("pickup_month"),
                      X.pickup_date("pickup_datetime").alias("pickup_date"))


_M = "date_sub('minute', tpep_pickup_datetime, tpep_dropoff_datetime)"


@register("avg_speed",
          f"SELECT trip_distance, {_M} AS trip_duration_minutes, "
          f"ROUND(CASE WHEN {_M} = 0 THEN 0 ELSE trip_distance / ({_M} / 60) END, 2) + 0.0 AS avg_speed_mph "
          f"FROM {_T_ALL}")
def avg_speed(spark, sf):
    """X5/X6/X7/X15."""
    raw = A.taxi_raw(spark, sf, "yellow")
    m = X.duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return raw.select("trip_distance", m.alias("trip_duration_minutes"),
                      X.avg_speed_mph("trip_distance", m).alias("avg_speed_mph"))


@register("safe_divide",
          f"SELECT fare_amount, passenger_count, fare_amount / NULLIF(passenger_count, 0) AS fare_per_passenger "
          f"FROM {_T_ALL}")
def safe_divide(spark, sf):
    """NULL instead of a division-by-zero error."""
    raw = A.taxi_raw(spark, sf, "yellow")
    return raw.select("fare_amount", "passenger_count",
                      X.safe_divide("fare_amount", "passenger_count").alias("fare_per_passenger"))


@register("surrogate_key", f"SELECT {Q.key_sql()} AS trip_id, {', '.join(TRIP_KEY)} FROM {Q.union_sql()}")
def surrogate_key(spark, sf):
    """X14 over the unified trips."""
    u = M.unioned(spark, sf)
    return u.select(X.surrogate_key(*TRIP_KEY).alias("trip_id"), *TRIP_KEY)


@register("cast_whole_units",
          f"SELECT tip_amount, CAST(tip_amount AS DECIMAL(10,0)) AS tip_units FROM {_T_ALL}")
def cast_whole_units(spark, sf):
    """cast('decimal') = decimal(10,0), HALF_UP."""
    raw = A.taxi_raw(spark, sf, "yellow")
    return raw.select("tip_amount", X.whole_units("tip_amount").alias("tip_units"))


# --- dedup, incremental (W1, F9, F10, A5, J2, K5) ---------------------------------------------

_TWO_RUNS = f"(SELECT * FROM {Q.union_sql(A.RUN_1)} UNION ALL SELECT * FROM {Q.union_sql(A.RUN_2)})"


@register("dedup_latest", f"SELECT * FROM {Q.dedup_sql(_TWO_RUNS)}")
def dedup_latest_q(spark, sf):
    """The same month loaded twice; the later run's copy survives."""
    u = M.unioned(spark, sf, (A.RUN_1, A.RUN_2))
    return dedup_latest(u, TRIP_KEY, "ingestion_timestamp", fact_plan.TIE_BREAKERS)


@register("fact_two_runs", f"SELECT * FROM {Q.fact_sql(_TWO_RUNS)}")
def fact_two_runs(spark, sf):
    return M.fact(spark, sf, (A.RUN_1, A.RUN_2))


CUTOFF = "1998-01-01"
_U1 = Q.union_sql(A.RUN_1)
BUCKETS = 2  # of the bucketed fact; its folders are those of the dates times this
_MARK = f"(SELECT MAX(pickup_date) FROM {_U1} WHERE pickup_date < DATE '{CUTOFF}')"


@register("incremental_filter", f"SELECT * FROM {Q.union_sql(A.RUN_2)} WHERE pickup_date >= {_MARK}")
def incremental_filter(spark, sf):
    """Rows at or after the existing fact's MAX(pickup_date)."""
    path = scratch_dir(spark, "fct_trips")
    first = M.unioned(spark, sf, (A.RUN_1,)).where(F.col("pickup_date") < F.lit(CUTOFF).cast("date"))
    fact_plan.refresh_fact(spark, first, path)
    mark = high_water_mark(spark.read.parquet(path))  # of the partition column: no data is read
    return flt.at_or_after(M.unioned(spark, sf, (A.RUN_2,)), "pickup_date", mark)


@register("incremental_upsert",
          f"SELECT * FROM {Q.fact_sql(f'(SELECT * FROM {_U1} WHERE pickup_date < {_MARK} UNION ALL SELECT * FROM {Q.union_sql(A.RUN_2)} WHERE pickup_date >= {_MARK})')}")
def incremental_upsert(spark, sf):
    """Full refresh of trips before the cutoff, then an
    incremental run of a later load: rows at the high-water mark are
    replaced, later ones inserted, earlier ones kept."""
    path = scratch_dir(spark, "fct_trips")
    first = M.unioned(spark, sf, (A.RUN_1,)).where(F.col("pickup_date") < F.lit(CUTOFF).cast("date"))
    fact_plan.refresh_fact(spark, first, path)
    fact_plan.refresh_fact(spark, M.unioned(spark, sf, (A.RUN_2,)), path)
    return fact_plan.fact_columns(spark.read.parquet(path))


@register("incremental_upsert_bucketed", ORACLE["incremental_upsert"])
def incremental_upsert_bucketed(spark, sf):
    """K5/J2 as in incremental_upsert, on a fact bucketed by its key: the target is not shuffled."""
    path = scratch_dir(spark, "fct_trips_bucketed")
    table = os.path.basename(path).replace("-", "_")
    first = M.unioned(spark, sf, (A.RUN_1,)).where(F.col("pickup_date") < F.lit(CUTOFF).cast("date"))
    bucketed.declare(spark, table, path, FACT, BUCKETS)
    bucketed.upsert_bucketed(spark, table, fact_plan.latest_trips(first), BUCKETS, computed=fact_plan.trip_id())
    later = flt.at_or_after(M.unioned(spark, sf, (A.RUN_2,)), "pickup_date", high_water_mark(spark.table(table)))
    bucketed.upsert_bucketed(spark, table, fact_plan.latest_trips(later), BUCKETS, computed=fact_plan.trip_id())
    return fact_plan.fact_columns(spark.table(table))


_TWO_LOADS = Q.fact_sql(f"(SELECT * FROM {_U1} WHERE pickup_date < {_MARK} UNION ALL SELECT * FROM {Q.union_sql(A.RUN_2)} WHERE pickup_date >= {_MARK})")


def _kept_states(spark, sf):
    """Partial states after a first load of the trips before the cutoff and an incremental one of a later delivery."""
    fact, states = scratch_dir(spark, "fct_trips"), scratch_dir(spark, "mart-states")
    first = M.unioned(spark, sf, (A.RUN_1,)).where(F.col("pickup_date") < F.lit(CUTOFF).cast("date"))
    kept_marts.incremental_run(spark, first, fact, states)
    kept_marts.incremental_run(spark, M.unioned(spark, sf, (A.RUN_2,)), fact, states)
    return spark.read.parquet(states)


@register("mart_daily_incremental", Q.daily_summary_sql(_TWO_LOADS))
def mart_daily_incremental(spark, sf):
    """The daily summary merged from states whose touched dates were replaced."""
    return kept_marts.daily_summary(_kept_states(spark, sf))


@register("mart_zone_incremental", Q.zone_performance_sql(_TWO_LOADS, ZONES_SQL))
def mart_zone_incremental(spark, sf):
    """Zone performance over all dates, merged from the same states."""
    return kept_marts.zone_performance(_kept_states(spark, sf), M.zone_dim(spark, sf))


# --- checks and metrics (T1-T7) ------------------------------------------------------------

_FACT = Q.fact_sql(Q.union_sql())
_FACT_NN = ("trip_id", "pickup_datetime", "dropoff_datetime", "trip_type", "source_file")


@register("check_not_null",
          " UNION ALL ".join(f"SELECT '' AS model, '{c}' AS column_name, 'not_null' AS test, "
                             f"COUNT_IF({c} IS NULL) AS failures FROM {Q.union_sql()}"
                             for c in ("pickup_datetime", "vendor_id", "passenger_count", "airport_fee")))
def check_not_null(spark, sf):
    """T1 in one pass over the union (vendor, passengers, airport fee have NULLs)."""
    return quality.check_not_null(M.unioned(spark, sf), "pickup_datetime", "vendor_id",
                                  "passenger_count", "airport_fee")


@register("check_unique",
          f"SELECT trip_id, COUNT(*) AS n_records FROM (SELECT {Q.key_sql()} AS trip_id FROM {_TWO_RUNS}) "
          "WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING COUNT(*) > 1")
def check_unique(spark, sf):
    """Duplicated keys before dedup (every trip loaded twice)."""
    u = M.unioned(spark, sf, (A.RUN_1, A.RUN_2)).select(X.surrogate_key(*TRIP_KEY).alias("trip_id"))
    return quality.unique_violations(u, "trip_id")


@register("check_unique_incremental",
          f"WITH f AS MATERIALIZED (SELECT trip_id, pickup_date, pu_location_id AS pu, do_location_id AS d FROM {Q.fact_sql(_U1)}) "
          "SELECT trip_id, COUNT(*) AS n_records FROM (SELECT trip_id FROM f "
          f"UNION ALL SELECT trip_id FROM f WHERE pickup_date >= DATE '{CUTOFF}' AND d % 50 = 0 "
          f"UNION ALL SELECT trip_id FROM f WHERE pickup_date < DATE '{CUTOFF}' AND pu % 40 = 0) "
          "GROUP BY trip_id HAVING COUNT(*) > 1")
def check_unique_incremental(spark, sf):
    """T2 from digests kept between two runs: the second load repeats keys within its dates and of earlier dates."""
    path, state = scratch_dir(spark, "fct_trips"), scratch_dir(spark, "key-digests")
    mark = F.lit(CUTOFF).cast("date")
    whole = scratch_dir(spark, "fct_trips")
    sinks.write_table(fact_plan.latest_trips(M.unioned(spark, sf, (A.RUN_1,))), whole)
    fact = spark.read.parquet(whole)  # without trip_id, which the writes below add behind their shuffles
    first, later = fact.where(F.col("pickup_date") < mark), fact.where(F.col("pickup_date") >= mark)
    sinks.write_partitioned(first, path, "pickup_date", computed=fact_plan.trip_id())
    duplicated_keys(spark, path, state)
    moved = first.where("pu_location_id % 40 = 0").withColumn("pickup_date", mark)
    batch = later.unionByName(later.where("do_location_id % 50 = 0")).unionByName(moved)
    sinks.write_partitioned(batch, path, "pickup_date", computed=fact_plan.trip_id())
    return duplicated_keys(spark, path, state, batch.select("pickup_date"))


@register("check_accepted_values",
          f"SELECT '' AS model, 'vendor_id' AS column_name, 'accepted_values' AS test, "
          f"COUNT_IF(NOT vendor_id IN (1, 2, 7)) AS failures FROM {Q.union_sql()} UNION ALL "
          f"SELECT '', 'trip_type', 'accepted_values', COUNT_IF(NOT trip_type IN ('yellow','green','hvfhv')) "
          f"FROM {Q.union_sql()}")
def check_accepted_values(spark, sf):
    """NULL passes; vendor 3 fails the documented set (1, 2, 7)."""
    u = M.unioned(spark, sf)
    return quality.check_accepted_values(u, "vendor_id", (1, 2, 7)).unionByName(
        quality.check_accepted_values(u, "trip_type", ("yellow", "green", "hvfhv")))


@register("probe_counts",
          f"SELECT COUNT(*) AS rows, COUNT_IF(trip_distance < 0) AS negative_distance, "
          f"COUNT_IF(tpep_pickup_datetime > tpep_dropoff_datetime) AS pickup_after_dropoff FROM {_T_ALL}")
def probe_counts(spark, sf):
    """T4/T5 in one aggregate."""
    raw = A.taxi_raw(spark, sf, "yellow")
    return quality.probe_counts(raw, {"negative_distance": F.col("trip_distance") < 0,
                                      "pickup_after_dropoff": F.col("tpep_pickup_datetime")
                                      > F.col("tpep_dropoff_datetime")})


# --- Q13 suite, T6 run metrics ---------------------------------------------------------------

from tripmart.plans import suite as S  # noqa: E402
from tripmart.schemas import SEEDS  # noqa: E402


def _suite_sql(union: str, fact: str) -> str:
    srcs = {f"stg_{s}_trips": f"(SELECT * FROM {union} WHERE source_file = '{s}_tripdata.parquet')" for s in ("yellow", "green", "hvfhv")}
    srcs.update({
        "stg_fhv_trips": Q.service_staged_sql("fhv"),
        "int_all_trips_unioned": union,
        "dim_taxi_zones": A.ZONES_SQL,
        "dim_rate_codes": Q.values_sql(seeds.RATE_CODES, SEEDS["rate_codes"]),
        "dim_vendors": Q.values_sql(seeds.VENDORS, SEEDS["vendors"]),
        "dim_payment_types": Q.values_sql(seeds.PAYMENT_TYPES, SEEDS["payment_types"]),
        "dim_hvfhv_bases": Q.values_sql(seeds.HVFHV_BASES, SEEDS["hvfhv_bases"]),
        "fct_trips": fact,
        "mart_daily_summary": f"({Q.daily_summary_sql(fact)})",
        "mart_zone_performance": f"({Q.zone_performance_sql(fact, A.ZONES_SQL)})",
        "mart_revenue_breakdown": f"({Q.revenue_breakdown_sql(fact)})",
    })
    parts = [p for spec in S.SUITE for p in Q.model_tests_sql(spec.model, srcs[spec.model], spec)]
    return " UNION ALL ".join(parts)


@register("test_suite", _suite_sql(Q.union_sql(), Q.fact_sql(Q.union_sql())))
def test_suite(spark, sf):
    """Q13: all 48 declared tests (not_null, unique, accepted_values)."""
    return S.test_suite(spark, sf)


_PLANTED = (f"(SELECT * REPLACE (CASE WHEN do_location_id % 40 = 0 THEN 'unknown' ELSE trip_type END AS trip_type, "
            f"CASE WHEN do_location_id % 30 = 0 THEN NULL ELSE dropoff_datetime END AS dropoff_datetime) FROM {Q.union_sql()})")
_PLANTED_FACT = f"(SELECT {Q.key_sql()} AS trip_id, * FROM {_PLANTED})"


@register("test_suite_planted", _suite_sql(_PLANTED, _PLANTED_FACT))
def test_suite_planted(spark, sf):
    """Q13 on models that must fail: unknown trip types, missing times, and a fact that was never
    deduplicated; tests of each kind count failures."""
    return S.test_suite(spark, sf, planted=True)


_BEFORE = f"(SELECT * FROM {Q.union_sql()} WHERE pickup_date < DATE '{CUTOFF}')"


def _publications(spark, sf) -> str:
    """Two builds of the fact's trips before the cutoff: one that passes its tests, and one that was never deduplicated
    and has unknown types."""

    root, spec = scratch_dir(spark, "published"), next(t for t in S.SUITE if t.model == "fct_trips")
    path = scratch_dir(spark, "unioned")
    sinks.write_table(M.unioned(spark, sf), path)
    unioned = spark.read.parquet(path)
    before = unioned.where(F.col("pickup_date") < F.lit(CUTOFF).cast("date"))
    bad = before.withColumn("trip_type", F.expr("CASE WHEN do_location_id % 40 = 0 THEN 'unknown' ELSE trip_type END"))
    publish_plan.publish(spark, root, "fct_trips", fact_plan.build_fact(before), spec)
    publish_plan.publish(spark, root, "fct_trips", bad.select(X.surrogate_key(*TRIP_KEY).alias("trip_id"), "*"), spec)
    return root


@register("publish_audited", f"SELECT * FROM {Q.fact_sql(_BEFORE)}")
def publish_audited(spark, sf):
    """Q9/Q13: what readers see after a build that failed its tests: the version before it, whole."""
    return fact_plan.fact_columns(publish_plan.current(spark, _publications(spark, sf), "fct_trips"))


@register("publish_log", f"""WITH bad AS (SELECT {Q.key_sql()} AS trip_id, CASE WHEN do_location_id % 40 = 0 THEN 'unknown' ELSE trip_type END AS t FROM {_BEFORE})
    SELECT 1 AS version, TRUE AS published, NULL::VARCHAR AS column_name, NULL::VARCHAR AS test, NULL::BIGINT AS failures
    UNION ALL SELECT 2, FALSE, 'trip_id', 'unique', (SELECT COUNT(*) FROM (SELECT trip_id FROM bad GROUP BY trip_id HAVING COUNT(*) > 1))
    UNION ALL SELECT 2, FALSE, 'trip_type', 'accepted_values', (SELECT COUNT(*) FROM bad WHERE t = 'unknown')""")
def publish_log(spark, sf):
    """Q9/Q13: the log of both builds, a row per failed test."""
    log = publish_plan.versions(spark, _publications(spark, sf))
    return log.select(F.col("version").cast("int"), "published", F.explode_outer("failures").alias("f")).select(
        "version", "published", "f.column_name", "f.test", "f.failures")


def _metrics(name: str, service: str) -> None:
    raw = A.service_raw_sql(service, split=False)
    taxi = service in ("yellow", "green")
    kept = Q.ingest_sql(service, split=False)
    p, d = Q.PICKUP[service], Q.DROPOFF[service]
    if taxi:
        sql = (f"SELECT '{service}' AS service, (SELECT COUNT(*) FROM {raw}) AS raw, COUNT(*) AS validated, COUNT(*) AS written, "
               f"COUNT_IF(trip_distance < 0) AS negative_distance, COUNT_IF({p} > {d}) AS pickup_after_dropoff FROM {kept}")
    else:
        located = f"(SELECT * FROM {raw} WHERE NOT ({'PUlocationID' if service == 'fhv' else 'PULocationID'} IS NULL AND {'DOlocationID' if service == 'fhv' else 'DOLocationID'} IS NULL))"
        sql = (f"SELECT '{service}' AS service, (SELECT COUNT(*) FROM {raw}) AS raw, "
               f"CASE WHEN COUNT_IF({p} >= {d}) > 0 THEN COUNT_IF({p} <> {d}) ELSE COUNT(*) END AS validated, "
               f"(SELECT COUNT(*) FROM {kept}) AS written, COUNT_IF({p} >= {d}) AS pickup_not_before_dropoff, "
               f"COUNT_IF({p} <> {d}) AS pickup_differs_dropoff FROM {located}")

    def run(spark, sf):
        raw_path = scratch_dir(spark, f"landing-{service}")
        A.service_raw(spark, sf, service, split=False).write.parquet(raw_path)
        m = run_ingest(spark, raw_path, scratch_dir(spark, service), SERVICES[service],
                       source_file=A.source_file_name(service), ingested_at=A.RUN_1)
        cols = ["raw", "validated", "written"] + (["negative_distance", "pickup_after_dropoff"] if taxi else
                                                  ["pickup_not_before_dropoff", "pickup_differs_dropoff"])
        return spark.createDataFrame([(service, *[int(m[c]) for c in cols])],
                                     "service string, " + ", ".join(f"{c} bigint" for c in cols))

    run.__name__ = name
    run.__doc__ = f"""T6: the {service} job run from a written monthly file: raw / validated / written counts and
    probe counts gathered by observe during the write."""
    register(name, sql)(run)


_metrics("run_metrics", "yellow")
_metrics("run_metrics_green", "green")
_metrics("run_metrics_fhv", "fhv")
_metrics("run_metrics_hvfhv", "hvfhv")


# --- whole project: lakes -> load -> views -> dims/fact/marts tables ---------------------------

from tripmart.plans import project as P  # noqa: E402


@register("warehouse_build", Q.daily_summary_sql(Q.fact_sql(Q.union_sql())))
def warehouse_build(spark, sf):
    """Q1-Q12 materialized: each unioned service ingested into its own
    date-partitioned lake, loaded by name with the bad-file probe, staged,
    unioned, fact written incrementally, marts written; returns the written
    daily summary."""
    root = scratch_dir(spark, "warehouse")
    lakes = {}
    for s in ("yellow", "green", "hvfhv"):
        lakes[s] = os.path.join(root, "lake", SERVICES[s].folder)
        sinks.write_partitioned(M.ingested(spark, sf, s), lakes[s], "pickup_date")
    paths = P.run_project(spark, lakes, os.path.join(root, "warehouse"),
                          seeds={"taxi_zone_lookup": A.zones(spark, sf)})
    return spark.read.parquet(paths["mart_daily_summary"])


@register("post_load_check", f"SELECT COUNT(*) AS rows, 24 AS columns_in_files, 1 AS columns_missing, 13 AS columns_type_differs, "
          f"0 AS columns_not_declared FROM {_YELLOW_INGEST}")
def post_load_check(spark, sf):
    """Row count and column comparison after loading the written yellow
    dataset (one row; the counts of columns are file metadata)."""
    return L.post_load_check(spark, _written_yellow(spark, sf), SERVICES["yellow"].table)


# --- sums of doubles without a fixed scale ------------------------------------------------------

from tripmart.operators.exact_sums import exact_sums  # noqa: E402
from tripmart.plans import exact_marts  # noqa: E402


@register("exact_sums_lineitem", f"""SELECT l_returnflag, l_linestatus, COUNT(*) AS n_rows,
    {Q.exact_sum_sql("l_extendedprice")} AS price_sum, COUNT(l_extendedprice) AS price_n,
    {Q.exact_sum_sql("l_extendedprice * (1 - l_discount) * (1 + l_tax)")} AS charge_sum, COUNT(l_extendedprice) AS charge_n,
    {Q.exact_sum_sql("l_extendedprice / l_quantity / 65536")} AS part_sum, COUNT(l_extendedprice) AS part_n
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def exact_sums_lineitem(spark, sf):
    """A2/A3: sums of doubles with all their bits, rounded once."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_returnflag", "l_linestatus", F.col("l_extendedprice").alias("price"),
        F.expr("l_extendedprice * (1 - l_discount) * (1 + l_tax)").alias("charge"),
        F.expr("l_extendedprice / l_quantity / 65536").alias("part"))
    return exact_sums(rows, ["l_returnflag", "l_linestatus"], ["price", "charge", "part"])


@register("mart_daily_exact", Q.daily_exact_sql(Q.fact_sql(Q.union_sql())))
def mart_daily_exact(spark, sf):
    """Q10 with sums of the doubles as they are."""
    return exact_marts.daily_summary(M.fact(spark, sf))


@register("mart_revenue_exact", Q.revenue_exact_sql(Q.fact_sql(Q.union_sql())))
def mart_revenue_exact(spark, sf):
    """Q12 with sums of the doubles as they are."""
    return exact_marts.revenue_breakdown(M.fact(spark, sf))


@register("mart_zone_exact", Q.zone_exact_sql(Q.fact_sql(Q.union_sql()), ZONES_SQL))
def mart_zone_exact(spark, sf):
    """Q11 with sums of the doubles as they are."""
    return exact_marts.zone_performance(M.fact(spark, sf), M.zone_dim(spark, sf))
