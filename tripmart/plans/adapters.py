"""Driver tables shaped as ride-service files.

The test tables hold no trips, so the pipeline runs on trips derived from
them (every row of the source tables is used):

* ``lineitem ⋈ orders`` -> taxi / HVFHV trips: pickup = order date, dropoff =
  ship date, pickup location = supplier (NULL for every 25th), dropoff location
  = part, fare = extended price, distance = quantity plus thousandths. Lines
  with number 4 arrive twice in one run, the second time corrected (a higher
  discount, hence tip), and lines with number 5 arrive twice alike: the fact
  has ties to break and copies to drop. The three unioned services split the
  table by ``l_returnflag`` (A -> yellow, N -> green, R -> HVFHV), so their
  union covers all of it.
* ``events`` -> FHV trips: pickup = ts, dropoff = ts + floor(value*10) s
  (sub-minute and zero-length trips), locations with injected NULLs.
* ``supplier ⋈ nation ⋈ region`` -> the zone lookup (LocationID = supplier).

Each Spark adapter has a DuckDB SQL twin (``*_sql``) used by the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import FHV_RAW, GREEN_RAW, HVFHV_RAW, YELLOW_RAW

# Fixed run stamps so repeated runs (and the SQL oracle) agree.
RUN_1 = "2026-05-01 06:00:00"
RUN_2 = "2026-05-02 06:00:00"

FLAGS = {"yellow": "A", "green": "N", "hvfhv": "R"}


def source_file_name(service: str) -> str:
    return f"{service}_tripdata.parquet"


_READS: dict[tuple[str, int, str], DataFrame] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One DataFrame per driver table and session (the tables are read-only):
    the footer-based schema inference runs once, not once per use. Keyed by
    the application id too, so a restarted context never sees a stale plan."""
    key = (spark.sparkContext.applicationId, id(spark), f"{sf_dir}/{name}.parquet")
    if key not in _READS:
        _READS[key] = spark.read.parquet(key[2])
    return _READS[key]


def _by_date(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("day_", F.to_date(ts)).hint("rebalance", "day_")


def line_orders(spark: SparkSession, sf_dir: str, flag: str | None = None, by_date: bool = False) -> DataFrame:
    """``by_date``: rows are dealt to the writers of a dataset partitioned by date here, before they grow by other columns."""
    li = _read(spark, sf_dir, "lineitem")
    if flag is not None:
        li = li.where(F.col("l_returnflag") == flag)
    o = _read(spark, sf_dir, "orders")
    # Lines are sent again behind the join, which thus shuffles each of them once.
    both = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    both = (_by_date(both, "o_orderdate") if by_date else both).select(
        "*", F.explode(F.expr("CASE WHEN l_linenumber IN (4, 5) THEN array(0, 1) ELSE array(0) END")).alias("sent"))
    return both.withColumn("l_discount", F.expr("CASE WHEN sent = 1 AND l_linenumber = 4 THEN l_discount + CAST(0.01 AS DOUBLE) ELSE l_discount END")).drop("sent")


# Column expressions of each shaped file, written once in SQL both engines
# parse (Spark via ``selectExpr``, DuckDB in the oracle): the two sides are
# the same text, and Spark builds each projection in a single call.
_DISTANCE = "l_quantity + l_linenumber * 2 / CAST(1000 AS DOUBLE)"
_PICKUP_ZONE = "CASE WHEN l_suppkey % 25 <> 0 THEN CAST(l_suppkey AS INTEGER) END"
_AIRPORT = "CASE WHEN l_linenumber % 2 = 1 THEN CAST(1.75 AS DOUBLE) END"
_TOTAL = "(l_extendedprice + l_tax + l_discount + l_discount * 10 + l_tax + CAST(1.0 AS DOUBLE))"

TAXI_EXPRS = {
    "VendorID": "CAST(l_linenumber % 3 + 1 AS INTEGER)",
    "passenger_count": "CAST(l_linenumber % 7 AS BIGINT)",
    "trip_distance": _DISTANCE,
    "RatecodeID": "CAST(o_custkey % 6 + 1 AS BIGINT)",
    "store_and_fwd_flag": "l_linestatus",
    "PULocationID": _PICKUP_ZONE,
    "DOLocationID": "CAST(l_partkey AS INTEGER)",
    "payment_type": "CAST(substr(o_orderpriority, 1, 1) AS BIGINT)",
    "fare_amount": "l_extendedprice",
    "extra": "l_tax",
    "mta_tax": "l_discount",
    "tip_amount": "l_discount * 10",
    "tolls_amount": "l_tax",
    "improvement_surcharge": "CAST(1.0 AS DOUBLE)",
    "total_amount": _TOTAL,
    "congestion_surcharge": "l_tax",
    "airport_fee": _AIRPORT,
    "cbd_congestion_fee": "l_discount",
    "ehail_fee": "CAST(NULL AS DOUBLE)",
    "trip_type": "CAST(l_linenumber % 2 + 1 AS BIGINT)",
}

HVFHV_EXPRS = {
    "hvfhs_license_num": "'HV000' || CAST(l_suppkey % 4 + 2 AS STRING)",
    "dispatching_base_num": "'B' || lpad(CAST(l_suppkey AS STRING), 5, '0')",
    "originating_base_num": "'B' || lpad(CAST(l_suppkey AS STRING), 5, '0')",
    "request_datetime": "o_orderdate",
    "on_scene_datetime": "o_orderdate",
    "pickup_datetime": "o_orderdate",
    "dropoff_datetime": "l_shipdate",
    "PULocationID": _PICKUP_ZONE,
    "DOLocationID": "CAST(l_partkey AS INTEGER)",
    "trip_miles": _DISTANCE,
    "trip_time": "CAST(l_linenumber * 60 AS BIGINT)",
    "base_passenger_fare": "l_extendedprice",
    "tolls": "l_tax",
    "bcf": "l_discount",
    "sales_tax": "l_tax",
    "congestion_surcharge": "l_tax",
    "airport_fee": _AIRPORT,
    "tips": "l_discount * 10",
    "driver_pay": "l_extendedprice - l_tax",
    "shared_request_flag": "CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END",
    "shared_match_flag": "'N'",
    "access_a_ride_flag": "'N'",
    "wav_request_flag": "'N'",
    "wav_match_flag": "'N'",
    "cbd_congestion_fee": "l_discount",
}

_BASE_NUM = "'B' || lpad(CAST(user_id AS STRING), 5, '0')"
FHV_EXPRS = {
    "dispatching_base_num": _BASE_NUM,
    "pickup_datetime": "ts",
    "dropOff_datetime": None,   # dialect-specific, see below
    "PUlocationID": "CASE WHEN event_type <> 'error' THEN user_id END",
    "DOlocationID": "CASE WHEN event_type NOT IN ('error', 'view') THEN user_id + 1000 END",
    "SR_Flag": "CASE WHEN event_type = 'purchase' THEN CAST(1 AS BIGINT) END",
    "Affiliated_base_number": _BASE_NUM,
}
FHV_DROPOFF_SPARK = "timestampadd(SECOND, floor(value * 10), ts)"
FHV_DROPOFF_DUCKDB = "ts + to_seconds(CAST(floor(value * 10) AS BIGINT))"


def taxi_exprs(service: str) -> tuple[dict, object]:
    schema, prefix = (YELLOW_RAW, "tpep") if service == "yellow" else (GREEN_RAW, "lpep")
    cols = dict(TAXI_EXPRS)
    cols[f"{prefix}_pickup_datetime"] = "o_orderdate"
    cols[f"{prefix}_dropoff_datetime"] = "l_shipdate"
    return cols, schema


def _shape(df: DataFrame, exprs: dict, schema) -> DataFrame:
    return df.selectExpr(*[f"CAST({exprs[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`"
                           for f in schema.fields])


def taxi_raw(spark: SparkSession, sf_dir: str, service: str = "yellow", flag: str | None = None, by_date: bool = False) -> DataFrame:
    """Yellow- or green-shaped raw file (``flag=None``: the whole table)."""
    cols, schema = taxi_exprs(service)
    return _shape(line_orders(spark, sf_dir, flag, by_date), cols, schema)


def hvfhv_raw(spark: SparkSession, sf_dir: str, flag: str | None = None, by_date: bool = False) -> DataFrame:
    return _shape(line_orders(spark, sf_dir, flag, by_date), HVFHV_EXPRS, HVFHV_RAW)


def fhv_raw(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    return _shape(_by_date(events, "ts") if by_date else events, dict(FHV_EXPRS, dropOff_datetime=FHV_DROPOFF_SPARK), FHV_RAW)


def service_raw(spark: SparkSession, sf_dir: str, service: str, split: bool = True, by_date: bool = False) -> DataFrame:
    """Raw file of one service; ``split`` restricts taxi/HVFHV to that
    service's share of lineitem (for the three-service union)."""
    flag = FLAGS.get(service) if split else None
    if service in ("yellow", "green"):
        return taxi_raw(spark, sf_dir, service, flag, by_date)
    if service == "hvfhv":
        return hvfhv_raw(spark, sf_dir, flag, by_date)
    return fhv_raw(spark, sf_dir, by_date)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (_read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("s_suppkey").cast("int").alias("LocationID"), F.col("r_name").alias("Borough"),
                     F.col("n_name").alias("Zone"),
                     F.concat(F.col("r_name"), F.lit(" Zone")).alias("service_zone")))


# --- SQL twins (DuckDB) -------------------------------------------------------

def line_orders_sql(flag: str | None = None) -> str:
    where = f"WHERE l_returnflag = '{flag}'" if flag else ""
    sent = ("(SELECT * FROM lineitem UNION ALL SELECT * REPLACE (l_discount + CAST(0.01 AS DOUBLE) AS l_discount) FROM lineitem "
            "WHERE l_linenumber = 4 UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 5)")
    return f"(SELECT * FROM {sent} JOIN orders ON l_orderkey = o_orderkey {where})"


def _select_sql(exprs: dict, schema, source: str) -> str:
    sel = ", ".join(f"{exprs[f.name]} AS {f.name}" for f in schema.fields)
    return f"(SELECT {sel} FROM {source})"


def taxi_raw_sql(service: str = "yellow", flag: str | None = None) -> str:
    cols, schema = taxi_exprs(service)
    return _select_sql(cols, schema, line_orders_sql(flag))


def hvfhv_raw_sql(flag: str | None = None) -> str:
    return _select_sql(HVFHV_EXPRS, HVFHV_RAW, line_orders_sql(flag))


def fhv_raw_sql() -> str:
    return _select_sql(dict(FHV_EXPRS, dropOff_datetime=FHV_DROPOFF_DUCKDB), FHV_RAW, "events")


def service_raw_sql(service: str, split: bool = True) -> str:
    flag = FLAGS.get(service) if split else None
    if service in ("yellow", "green"):
        return taxi_raw_sql(service, flag)
    if service == "hvfhv":
        return hvfhv_raw_sql(flag)
    return fhv_raw_sql()


ZONES_SQL = """(SELECT CAST(s_suppkey AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone,
    r_name || ' Zone' AS service_zone
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
