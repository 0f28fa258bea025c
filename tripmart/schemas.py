"""Declared schemas: raw service files, typed raw tables, unified trip, seeds.

All columns are nullable. Timestamps are ``timestamp_ntz`` throughout:
trip records carry wall-clock times with no zone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DataType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampNTZType,
)

INT, LONG, DOUBLE, STR = IntegerType(), LongType(), DoubleType(), StringType()
TS, DATE = TimestampNTZType(), DateType()
MONEY = DecimalType(10, 2)


def struct(cols: list[tuple[str, DataType]]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


# Fixed values from here on: public column names and types, and the staged column order.

# --- raw service files (what the ingest jobs scan) -------------------------

YELLOW_RAW = struct([
    ("VendorID", INT), ("tpep_pickup_datetime", TS), ("tpep_dropoff_datetime", TS),
    ("passenger_count", LONG), ("trip_distance", DOUBLE), ("RatecodeID", LONG),
    ("store_and_fwd_flag", STR), ("PULocationID", INT), ("DOLocationID", INT),
    ("payment_type", LONG), ("fare_amount", DOUBLE), ("extra", DOUBLE),
    ("mta_tax", DOUBLE), ("tip_amount", DOUBLE), ("tolls_amount", DOUBLE),
    ("improvement_surcharge", DOUBLE), ("total_amount", DOUBLE),
    ("congestion_surcharge", DOUBLE), ("airport_fee", DOUBLE), ("cbd_congestion_fee", DOUBLE),
])

GREEN_RAW = struct([
    ("VendorID", INT), ("lpep_pickup_datetime", TS), ("lpep_dropoff_datetime", TS),
    ("store_and_fwd_flag", STR), ("RatecodeID", LONG), ("PULocationID", INT),
    ("DOLocationID", INT), ("passenger_count", LONG), ("trip_distance", DOUBLE),
    ("fare_amount", DOUBLE), ("extra", DOUBLE), ("mta_tax", DOUBLE), ("tip_amount", DOUBLE),
    ("tolls_amount", DOUBLE), ("ehail_fee", DOUBLE), ("improvement_surcharge", DOUBLE),
    ("total_amount", DOUBLE), ("payment_type", LONG), ("trip_type", LONG),
    ("congestion_surcharge", DOUBLE), ("cbd_congestion_fee", DOUBLE),
])

FHV_RAW = struct([
    ("dispatching_base_num", STR), ("pickup_datetime", TS), ("dropOff_datetime", TS),
    ("PUlocationID", LONG), ("DOlocationID", LONG), ("SR_Flag", LONG),
    ("Affiliated_base_number", STR),
])

HVFHV_RAW = struct([
    ("hvfhs_license_num", STR), ("dispatching_base_num", STR), ("originating_base_num", STR),
    ("request_datetime", TS), ("on_scene_datetime", TS), ("pickup_datetime", TS),
    ("dropoff_datetime", TS), ("PULocationID", INT), ("DOLocationID", INT),
    ("trip_miles", DOUBLE), ("trip_time", LONG), ("base_passenger_fare", DOUBLE),
    ("tolls", DOUBLE), ("bcf", DOUBLE), ("sales_tax", DOUBLE), ("congestion_surcharge", DOUBLE),
    ("airport_fee", DOUBLE), ("tips", DOUBLE), ("driver_pay", DOUBLE),
    ("shared_request_flag", STR), ("shared_match_flag", STR), ("access_a_ride_flag", STR),
    ("wav_request_flag", STR), ("wav_match_flag", STR), ("cbd_congestion_fee", DOUBLE),
])


# --- typed raw (landing) tables --------------------------------------------

def _retype(base: StructType, overrides: dict[str, DataType], extra: list[tuple[str, DataType]]) -> StructType:
    cols = [(f.name, overrides.get(f.name, f.dataType)) for f in base.fields]
    return struct(cols + extra)


_YELLOW_MONEY = ["trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                 "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
                 "cbd_congestion_fee"]

YELLOW_TABLE = _retype(YELLOW_RAW, {c: MONEY for c in _YELLOW_MONEY}, [
    ("trip_duration_minutes", INT), ("avg_speed_mph", MONEY), ("source_file", STR),
    ("ingested_at_timestamp", TS), ("pickup_date", DATE)])

GREEN_TABLE = _retype(GREEN_RAW, {}, [
    ("trip_duration_minutes", INT), ("avg_speed_mph", MONEY), ("source_file", STR),
    ("ingested_at_timestamp", TS), ("pickup_date", DATE)])

FHV_TABLE = _retype(FHV_RAW, {}, [
    ("trip_duration_minutes", INT), ("source_file", STR),
    ("ingestion_timestamp", TS), ("pickup_date", DATE)])

HVFHV_TABLE = _retype(HVFHV_RAW, {}, [
    ("trip_duration_minutes", INT), ("source_file", STR),
    ("ingestion_timestamp", TS), ("pickup_date", DATE)])


# --- unified trip (32 columns) and fact (trip_id + 32) ----------------------

UNIFIED = struct([
    ("vendor_id", INT), ("pickup_datetime", TS), ("dropoff_datetime", TS),
    ("passenger_count", LONG), ("trip_distance", DOUBLE), ("rate_code_id", LONG),
    ("store_and_fwd_flag", STR), ("pu_location_id", INT), ("do_location_id", INT),
    ("payment_type", LONG), ("fare_amount", DOUBLE), ("extra", DOUBLE), ("mta_tax", DOUBLE),
    ("tip_amount", DOUBLE), ("tolls_amount", DOUBLE), ("improvement_surcharge", DOUBLE),
    ("total_amount", DOUBLE), ("congestion_surcharge", DOUBLE), ("airport_fee", DOUBLE),
    ("cbd_congestion_fee", DOUBLE), ("trip_duration_minutes", INT), ("avg_speed_mph", MONEY),
    ("source_file", STR), ("ingestion_timestamp", TS), ("pickup_date", DATE), ("trip_type", STR),
    ("ehail_fee", DOUBLE), ("green_trip_type", LONG), ("hvfhs_license_num", STR),
    ("driver_pay", DOUBLE), ("shared_request_flag", STR), ("shared_match_flag", STR),
])

FACT = struct([("trip_id", STR)] + [(f.name, f.dataType) for f in UNIFIED.fields])

# Seven columns that identify a trip: dedup partition and surrogate-key inputs.
TRIP_KEY = ["pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id",
            "trip_type", "source_file", "fare_amount"]


# --- seeds -------------------------------------------------------------------

SEEDS = {
    "taxi_zone_lookup": struct([("LocationID", INT), ("Borough", STR), ("Zone", STR), ("service_zone", STR)]),
    "vendors": struct([("vendor_id", INT), ("vendor_name", STR)]),
    "rate_codes": struct([("rate_code_id", INT), ("rate_code_name", STR)]),
    "payment_types": struct([("payment_type_id", INT), ("payment_type_name", STR)]),
    "hvfhv_bases": struct([("hvfhs_license_num", STR), ("base_name", STR), ("base_type", STR)]),
}

# Declared lengths of the app-base seed (varchar(n)); enforced as a check.
SEED_LENGTHS = {"hvfhv_bases": {"hvfhs_license_num": 6, "base_name": 50, "base_type": 20}}


# --- services ----------------------------------------------------------------

@dataclass(frozen=True)
class Service:
    """Everything that differs between the four ride services."""
    name: str                 # trip_type literal after staging
    kind: str                 # "taxi" (yellow/green rules) or "fhv" (FHV/HVFHV rules)
    raw: StructType           # schema of the monthly file
    table: StructType         # typed raw table
    pickup: str
    dropoff: str
    pu: str
    do: str
    ts_col: str               # ingestion-timestamp column name written by the job
    folder: str               # output folder name below the lake root
    # staging: (raw-table column, staged name); order is the staged order
    staging: list[tuple[str, str]] = field(default_factory=list)


def _same(*cols: str) -> list[tuple[str, str]]:
    return [(c, c) for c in cols]


YELLOW = Service(
    "yellow", "taxi", YELLOW_RAW, YELLOW_TABLE, "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "PULocationID", "DOLocationID", "ingested_at_timestamp", "yellow",
    [("VendorID", "vendor_id"), ("tpep_pickup_datetime", "pickup_datetime"),
     ("tpep_dropoff_datetime", "dropoff_datetime")] + _same("passenger_count", "trip_distance")
    + [("RatecodeID", "rate_code_id")] + _same("store_and_fwd_flag")
    + [("PULocationID", "pu_location_id"), ("DOLocationID", "do_location_id")]
    + _same("payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
            "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
            "cbd_congestion_fee", "trip_duration_minutes", "avg_speed_mph", "source_file")
    + [("ingested_at_timestamp", "ingestion_timestamp")] + _same("pickup_date"),
)

GREEN = Service(
    "green", "taxi", GREEN_RAW, GREEN_TABLE, "lpep_pickup_datetime", "lpep_dropoff_datetime",
    "PULocationID", "DOLocationID", "ingested_at_timestamp", "green",
    [("VendorID", "vendor_id"), ("lpep_pickup_datetime", "pickup_datetime"),
     ("lpep_dropoff_datetime", "dropoff_datetime"), ("store_and_fwd_flag", "store_and_fwd_flag"),
     ("RatecodeID", "rate_code_id"), ("PULocationID", "pu_location_id"),
     ("DOLocationID", "do_location_id")]
    + _same("passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
            "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount", "payment_type")
    + [("trip_type", "green_trip_type")]
    + _same("congestion_surcharge", "cbd_congestion_fee", "trip_duration_minutes", "avg_speed_mph",
            "source_file")
    + [("ingested_at_timestamp", "ingestion_timestamp")] + _same("pickup_date"),
)

FHV = Service(
    "fhv", "fhv", FHV_RAW, FHV_TABLE, "pickup_datetime", "dropOff_datetime",
    "PUlocationID", "DOlocationID", "ingestion_timestamp", "fhv",
    [("dispatching_base_num", "dispatching_base_num"), ("pickup_datetime", "pickup_datetime"),
     ("dropOff_datetime", "dropoff_datetime"), ("PUlocationID", "pu_location_id"),
     ("DOlocationID", "do_location_id"), ("SR_Flag", "sr_flag"),
     ("Affiliated_base_number", "affiliated_base_number")]
    + _same("trip_duration_minutes", "source_file", "ingestion_timestamp", "pickup_date"),
)

HVFHV = Service(
    "hvfhv", "fhv", HVFHV_RAW, HVFHV_TABLE, "pickup_datetime", "dropoff_datetime",
    "PULocationID", "DOLocationID", "ingestion_timestamp", "fhvhv",
    _same("hvfhs_license_num", "dispatching_base_num", "originating_base_num", "request_datetime",
          "on_scene_datetime", "pickup_datetime", "dropoff_datetime")
    + [("PULocationID", "pu_location_id"), ("DOLocationID", "do_location_id")]
    + _same("trip_miles", "trip_time")
    + [("base_passenger_fare", "fare_amount"), ("tolls", "tolls_amount")]
    + _same("bcf", "sales_tax", "congestion_surcharge", "airport_fee")
    + [("tips", "tip_amount")]
    + _same("driver_pay", "shared_request_flag", "shared_match_flag", "access_a_ride_flag",
            "wav_request_flag", "wav_match_flag", "cbd_congestion_fee", "trip_duration_minutes",
            "source_file", "ingestion_timestamp", "pickup_date"),
)

SERVICES = {s.name: s for s in (YELLOW, GREEN, FHV, HVFHV)}


def lake_schema(service: Service) -> StructType:
    """Schema of a service's written (lake) files in file types: the raw
    columns plus what ingest derives (bigint duration, double speed, lineage
    columns). ``pickup_date`` comes from the directory names."""
    extra = [("trip_duration_minutes", LONG)]
    if service.kind == "taxi":
        extra.append(("avg_speed_mph", DOUBLE))
    extra += [("source_file", STR), (service.ts_col, TS)]
    return struct([(f.name, f.dataType) for f in service.raw.fields] + extra)

# Services in the unified trip table (FHV is staged but not unioned).
UNIONED = ("yellow", "green", "hvfhv")
