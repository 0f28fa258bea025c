"""DuckDB SQL of the pipeline models, for the correctness oracle.

Written out by hand, apart from the driver-table adapters (which shape the
inputs): column mappings, types, keys and orders are stated here and are not
taken from the Spark side, so a swapped mapping there shows as a difference.
Each builder returns a parenthesized subquery with the same columns, types and
semantics as the Spark model of the same name. Nothing here runs on Spark.
"""

from __future__ import annotations

from tripmart.plans.adapters import RUN_1, service_raw_sql

# The models' columns, as the declared schemas state them.

PICKUP = {"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime", "fhv": "pickup_datetime", "hvfhv": "pickup_datetime"}
DROPOFF = {"yellow": "tpep_dropoff_datetime", "green": "lpep_dropoff_datetime", "fhv": "dropOff_datetime", "hvfhv": "dropoff_datetime"}
STAMP = {"yellow": "ingested_at_timestamp", "green": "ingested_at_timestamp", "fhv": "ingestion_timestamp", "hvfhv": "ingestion_timestamp"}

TABLE = {
    "yellow": """CAST(VendorID AS INTEGER) AS VendorID, CAST(tpep_pickup_datetime AS TIMESTAMP) AS tpep_pickup_datetime,
        CAST(tpep_dropoff_datetime AS TIMESTAMP) AS tpep_dropoff_datetime, CAST(passenger_count AS BIGINT) AS passenger_count,
        CAST(trip_distance AS DECIMAL(10,2)) AS trip_distance, CAST(RatecodeID AS BIGINT) AS RatecodeID, store_and_fwd_flag,
        CAST(PULocationID AS INTEGER) AS PULocationID, CAST(DOLocationID AS INTEGER) AS DOLocationID,
        CAST(payment_type AS BIGINT) AS payment_type, CAST(fare_amount AS DECIMAL(10,2)) AS fare_amount,
        CAST(extra AS DECIMAL(10,2)) AS extra, CAST(mta_tax AS DECIMAL(10,2)) AS mta_tax, CAST(tip_amount AS DECIMAL(10,2)) AS tip_amount,
        CAST(tolls_amount AS DECIMAL(10,2)) AS tolls_amount, CAST(improvement_surcharge AS DECIMAL(10,2)) AS improvement_surcharge,
        CAST(total_amount AS DECIMAL(10,2)) AS total_amount, CAST(congestion_surcharge AS DECIMAL(10,2)) AS congestion_surcharge,
        CAST(airport_fee AS DECIMAL(10,2)) AS airport_fee, CAST(cbd_congestion_fee AS DECIMAL(10,2)) AS cbd_congestion_fee,
        CAST(trip_duration_minutes AS INTEGER) AS trip_duration_minutes, CAST(avg_speed_mph AS DECIMAL(10,2)) AS avg_speed_mph,
        source_file, ingested_at_timestamp, COALESCE(pickup_date, CAST(tpep_pickup_datetime AS DATE)) AS pickup_date""",
    "green": """CAST(VendorID AS INTEGER) AS VendorID, lpep_pickup_datetime, lpep_dropoff_datetime, store_and_fwd_flag,
        CAST(RatecodeID AS BIGINT) AS RatecodeID, CAST(PULocationID AS INTEGER) AS PULocationID,
        CAST(DOLocationID AS INTEGER) AS DOLocationID, CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance, fare_amount,
        extra, mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge, total_amount,
        CAST(payment_type AS BIGINT) AS payment_type, CAST(trip_type AS BIGINT) AS trip_type, congestion_surcharge, cbd_congestion_fee,
        CAST(trip_duration_minutes AS INTEGER) AS trip_duration_minutes, CAST(avg_speed_mph AS DECIMAL(10,2)) AS avg_speed_mph,
        source_file, ingested_at_timestamp, COALESCE(pickup_date, CAST(lpep_pickup_datetime AS DATE)) AS pickup_date""",
    "fhv": """dispatching_base_num, pickup_datetime, dropOff_datetime, CAST(PUlocationID AS BIGINT) AS PUlocationID,
        CAST(DOlocationID AS BIGINT) AS DOlocationID, CAST(SR_Flag AS BIGINT) AS SR_Flag, Affiliated_base_number,
        CAST(trip_duration_minutes AS INTEGER) AS trip_duration_minutes, source_file, ingestion_timestamp,
        COALESCE(pickup_date, CAST(pickup_datetime AS DATE)) AS pickup_date""",
    "hvfhv": """hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime, pickup_datetime,
        dropoff_datetime, CAST(PULocationID AS INTEGER) AS PULocationID, CAST(DOLocationID AS INTEGER) AS DOLocationID, trip_miles,
        CAST(trip_time AS BIGINT) AS trip_time, base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips,
        driver_pay, shared_request_flag, shared_match_flag, access_a_ride_flag, wav_request_flag, wav_match_flag, cbd_congestion_fee,
        CAST(trip_duration_minutes AS INTEGER) AS trip_duration_minutes, source_file, ingestion_timestamp,
        COALESCE(pickup_date, CAST(pickup_datetime AS DATE)) AS pickup_date""",
}

STAGED = {
    "yellow": """VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
        passenger_count, trip_distance, RatecodeID AS rate_code_id, store_and_fwd_flag, PULocationID AS pu_location_id,
        DOLocationID AS do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
        total_amount, congestion_surcharge, airport_fee, cbd_congestion_fee, trip_duration_minutes, avg_speed_mph, source_file,
        ingested_at_timestamp AS ingestion_timestamp, pickup_date, 'yellow' AS trip_type""",
    "green": """VendorID AS vendor_id, lpep_pickup_datetime AS pickup_datetime, lpep_dropoff_datetime AS dropoff_datetime,
        store_and_fwd_flag, RatecodeID AS rate_code_id, PULocationID AS pu_location_id, DOLocationID AS do_location_id,
        passenger_count, trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount, ehail_fee, improvement_surcharge,
        total_amount, payment_type, trip_type AS green_trip_type, congestion_surcharge, cbd_congestion_fee, trip_duration_minutes,
        avg_speed_mph, source_file, ingested_at_timestamp AS ingestion_timestamp, pickup_date, 'green' AS trip_type""",
    "fhv": """dispatching_base_num, pickup_datetime, dropOff_datetime AS dropoff_datetime, PUlocationID AS pu_location_id,
        DOlocationID AS do_location_id, SR_Flag AS sr_flag, Affiliated_base_number AS affiliated_base_number, trip_duration_minutes,
        source_file, ingestion_timestamp, pickup_date, 'fhv' AS trip_type""",
    "hvfhv": """hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime, pickup_datetime,
        dropoff_datetime, PULocationID AS pu_location_id, DOLocationID AS do_location_id, trip_miles, trip_time,
        base_passenger_fare AS fare_amount, tolls AS tolls_amount, bcf, sales_tax, congestion_surcharge, airport_fee,
        tips AS tip_amount, driver_pay, shared_request_flag, shared_match_flag, access_a_ride_flag, wav_request_flag, wav_match_flag,
        cbd_congestion_fee, trip_duration_minutes, source_file, ingestion_timestamp, pickup_date, 'hvfhv' AS trip_type""",
}

UNIFIED = {
    "yellow": """vendor_id, pickup_datetime, dropoff_datetime, passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
        rate_code_id, store_and_fwd_flag, pu_location_id, do_location_id, payment_type, CAST(fare_amount AS DOUBLE) AS fare_amount,
        CAST(extra AS DOUBLE) AS extra, CAST(mta_tax AS DOUBLE) AS mta_tax, CAST(tip_amount AS DOUBLE) AS tip_amount,
        CAST(tolls_amount AS DOUBLE) AS tolls_amount, CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge,
        CAST(total_amount AS DOUBLE) AS total_amount, CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge,
        CAST(airport_fee AS DOUBLE) AS airport_fee, CAST(cbd_congestion_fee AS DOUBLE) AS cbd_congestion_fee, trip_duration_minutes,
        avg_speed_mph, source_file, ingestion_timestamp, pickup_date, trip_type, CAST(NULL AS DOUBLE) AS ehail_fee,
        CAST(NULL AS BIGINT) AS green_trip_type, CAST(NULL AS VARCHAR) AS hvfhs_license_num, CAST(NULL AS DOUBLE) AS driver_pay,
        CAST(NULL AS VARCHAR) AS shared_request_flag, CAST(NULL AS VARCHAR) AS shared_match_flag""",
    "green": """vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, rate_code_id, store_and_fwd_flag,
        pu_location_id, do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
        total_amount, congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee, cbd_congestion_fee, trip_duration_minutes,
        avg_speed_mph, source_file, ingestion_timestamp, pickup_date, trip_type, ehail_fee, green_trip_type,
        CAST(NULL AS VARCHAR) AS hvfhs_license_num, CAST(NULL AS DOUBLE) AS driver_pay, CAST(NULL AS VARCHAR) AS shared_request_flag,
        CAST(NULL AS VARCHAR) AS shared_match_flag""",
    "hvfhv": """CAST(NULL AS INTEGER) AS vendor_id, pickup_datetime, dropoff_datetime, CAST(NULL AS BIGINT) AS passenger_count,
        trip_miles AS trip_distance, CAST(NULL AS BIGINT) AS rate_code_id, CAST(NULL AS VARCHAR) AS store_and_fwd_flag,
        pu_location_id, do_location_id, CAST(NULL AS BIGINT) AS payment_type, fare_amount, CAST(NULL AS DOUBLE) AS extra,
        CAST(NULL AS DOUBLE) AS mta_tax, tip_amount, tolls_amount, CAST(NULL AS DOUBLE) AS improvement_surcharge,
        CAST(NULL AS DOUBLE) AS total_amount, congestion_surcharge, airport_fee, cbd_congestion_fee, trip_duration_minutes,
        CAST(NULL AS DECIMAL(10,2)) AS avg_speed_mph, source_file, ingestion_timestamp, pickup_date, trip_type,
        CAST(NULL AS DOUBLE) AS ehail_fee, CAST(NULL AS BIGINT) AS green_trip_type, hvfhs_license_num, driver_pay,
        shared_request_flag, shared_match_flag""",
}

TRIP_ID = """md5(concat_ws('-', COALESCE(CAST(pickup_datetime AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
    COALESCE(CAST(dropoff_datetime AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
    COALESCE(CAST(pu_location_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
    COALESCE(CAST(do_location_id AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
    COALESCE(CAST(trip_type AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
    COALESCE(CAST(source_file AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
    COALESCE(CAST(fare_amount AS VARCHAR), '_dbt_utils_surrogate_key_null_')))"""

RANK = """ROW_NUMBER() OVER (
    PARTITION BY pickup_datetime, dropoff_datetime, pu_location_id, do_location_id, trip_type, source_file, fare_amount
    ORDER BY ingestion_timestamp DESC NULLS FIRST, trip_duration_minutes DESC NULLS LAST, tip_amount DESC NULLS LAST,
        total_amount DESC NULLS LAST, trip_distance DESC NULLS LAST, passenger_count DESC NULLS LAST,
        payment_type DESC NULLS LAST, vendor_id DESC NULLS LAST, mta_tax DESC NULLS LAST, cbd_congestion_fee DESC NULLS LAST)"""


# --- Q1-Q4 ---------------------------------------------------------------------

_TAXI_RULES = "NOT (payment_type = 2 AND CAST(tip_amount AS DECIMAL(10,0)) > 0) AND passenger_count <> 0 AND fare_amount > 0"


def ingest_sql(service: str, raw: str | None = None, start: str | None = None, end: str | None = None,
               stamp: str = RUN_1, split: bool = True) -> str:
    """One ingest job; ``start``/``end`` bound the pickup time (end exclusive)."""
    p, d = PICKUP[service], DROPOFF[service]
    minutes = f"date_sub('minute', {p}, {d})"
    taxi = service in ("yellow", "green")
    where = _TAXI_RULES if taxi else {
        "fhv": "NOT (PUlocationID IS NULL AND DOlocationID IS NULL)",
        "hvfhv": "NOT (PULocationID IS NULL AND DOLocationID IS NULL)"}[service] + f" AND NOT ({minutes} = 0)"
    if start:
        where += f" AND {p} >= TIMESTAMP '{start}'"
    if end:
        where += f" AND {p} < TIMESTAMP '{end}'"
    # Spark rounds through BigDecimal, which has no negative zero: + 0.0
    speed = (f"ROUND(CASE WHEN {minutes} = 0 THEN 0 ELSE trip_distance / ({minutes} / 60) END, 2) + 0.0 AS avg_speed_mph, "
             if taxi else "")
    return f"""(SELECT *, {minutes} AS trip_duration_minutes, {speed}'{service}_tripdata.parquet' AS source_file,
        TIMESTAMP '{stamp}' AS {STAMP[service]}, CAST({p} AS DATE) AS pickup_date
        FROM {raw or service_raw_sql(service, split)} WHERE {where})"""


# --- Q5-Q9 ---------------------------------------------------------------------

def table_sql(service: str, ingested: str) -> str:
    """Typed raw table (load by name + cast + back-fill)."""
    return f"(SELECT {TABLE[service]} FROM {ingested})"


def staged_sql(service: str, table: str) -> str:
    return f"(SELECT {STAGED[service]} FROM {table})"


def service_staged_sql(service: str, stamp: str = RUN_1, split: bool = True) -> str:
    return staged_sql(service, table_sql(service, ingest_sql(service, stamp=stamp, split=split)))


def union_sql(stamp: str = RUN_1) -> str:
    return "(" + " UNION ALL ".join(f"SELECT {UNIFIED[s]} FROM {service_staged_sql(s, stamp)}"
                                    for s in ("yellow", "green", "hvfhv")) + ")"


def key_sql() -> str:
    return TRIP_ID


def ranked_sql(src: str) -> str:
    return f"(SELECT *, {RANK} AS row_num FROM {src})"


def dedup_sql(src: str) -> str:
    return f"(SELECT * EXCLUDE (row_num) FROM {ranked_sql(src)} WHERE row_num = 1)"


def fact_sql(src: str) -> str:
    return f"(SELECT {TRIP_ID} AS trip_id, * FROM {dedup_sql(src)})"


# --- Q10-Q12 (sums of doubles in nine decimals: exact, and the same in any order) ---

def daily_summary_sql(fact: str) -> str:
    return f"""SELECT pickup_date, trip_type, COUNT(*) AS trip_count,
        CAST(SUM(CAST(fare_amount AS DECIMAL(28,9))) AS DOUBLE) / NULLIF(COUNT(fare_amount), 0) AS avg_fare_amount,
        CAST(SUM(CAST(trip_distance AS DECIMAL(28,9))) AS DOUBLE) / NULLIF(COUNT(trip_distance), 0) AS avg_trip_distance,
        AVG(trip_duration_minutes) AS avg_trip_duration_minutes,
        CAST(SUM(CAST(total_amount AS DECIMAL(28,9))) AS DOUBLE) AS total_revenue
        FROM {fact} GROUP BY pickup_date, trip_type"""


def revenue_breakdown_sql(fact: str) -> str:
    return f"""SELECT trip_type, pickup_date,
        CAST(SUM(CAST(fare_amount AS DECIMAL(28,9))) AS DOUBLE) AS fare_amount_total,
        CAST(SUM(COALESCE(CAST(tip_amount AS DECIMAL(28,9)), 0)) AS DOUBLE) AS tip_amount_total,
        CAST(SUM(COALESCE(CAST(tolls_amount AS DECIMAL(28,9)), 0)) AS DOUBLE) AS tolls_amount_total,
        CAST(SUM(COALESCE(CAST(congestion_surcharge AS DECIMAL(28,9)), 0)) AS DOUBLE) AS surcharge_total,
        CAST(SUM(COALESCE(CAST(airport_fee AS DECIMAL(28,9)), 0)) AS DOUBLE) AS airport_fee_total,
        CAST(SUM(CAST(total_amount AS DECIMAL(28,9))) AS DOUBLE) AS grand_total
        FROM {fact} GROUP BY trip_type, pickup_date"""


def zone_performance_sql(fact: str, zones: str) -> str:
    return f"""SELECT pu_location_id, b.Zone AS zone, b.Borough AS borough, COUNT(*) AS trip_count,
        CAST(SUM(CAST(total_amount AS DECIMAL(28,9))) AS DOUBLE) AS total_revenue,
        CAST(SUM(CAST(fare_amount AS DECIMAL(28,9))) AS DOUBLE) / NULLIF(COUNT(fare_amount), 0) AS avg_fare,
        CAST(SUM(CAST(trip_distance AS DECIMAL(28,9))) AS DOUBLE) / NULLIF(COUNT(trip_distance), 0) AS avg_distance
        FROM {fact} a JOIN {zones} b ON a.pu_location_id = b.LocationID
        GROUP BY pu_location_id, b.Zone, b.Borough"""


def exact_sum_sql(c: str) -> str:
    """The double nearest to the true sum, for values that are multiples of 2**-70 with sums below 2**57."""
    return f"CAST(CAST(SUM(CAST({c} * pow(2, 70) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / pow(2, 70)"


def daily_exact_sql(fact: str) -> str:
    return f"""SELECT pickup_date, trip_type, COUNT(*) AS trip_count,
        {exact_sum_sql("fare_amount")} / NULLIF(COUNT(fare_amount), 0) AS avg_fare_amount,
        {exact_sum_sql("trip_distance")} / NULLIF(COUNT(trip_distance), 0) AS avg_trip_distance,
        AVG(trip_duration_minutes) AS avg_trip_duration_minutes, {exact_sum_sql("total_amount")} AS total_revenue
        FROM {fact} GROUP BY pickup_date, trip_type"""


def revenue_exact_sql(fact: str) -> str:
    return f"""SELECT trip_type, pickup_date, {exact_sum_sql("fare_amount")} AS fare_amount_total,
        COALESCE({exact_sum_sql("tip_amount")}, 0) AS tip_amount_total,
        COALESCE({exact_sum_sql("tolls_amount")}, 0) AS tolls_amount_total,
        COALESCE({exact_sum_sql("congestion_surcharge")}, 0) AS surcharge_total,
        COALESCE({exact_sum_sql("airport_fee")}, 0) AS airport_fee_total, {exact_sum_sql("total_amount")} AS grand_total
        FROM {fact} GROUP BY trip_type, pickup_date"""


def zone_exact_sql(fact: str, zones: str) -> str:
    return f"""SELECT pu_location_id, b.Zone AS zone, b.Borough AS borough, COUNT(*) AS trip_count,
        {exact_sum_sql("total_amount")} AS total_revenue,
        {exact_sum_sql("fare_amount")} / NULLIF(COUNT(fare_amount), 0) AS avg_fare,
        {exact_sum_sql("trip_distance")} / NULLIF(COUNT(trip_distance), 0) AS avg_distance
        FROM {fact} a JOIN {zones} b ON a.pu_location_id = b.LocationID
        GROUP BY pu_location_id, b.Zone, b.Borough"""


def values_sql(rows, schema) -> str:
    """A small fixed table as a VALUES subquery."""
    def lit(v):
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v))
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f.name for f in schema.fields)
    return f"(SELECT * FROM (VALUES {body}) AS t({cols}))"


def model_tests_sql(model: str, src: str, spec) -> list[str]:
    out = []
    for c in spec.not_null:
        out.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, "
                   f"COUNT_IF({c} IS NULL) AS failures FROM {src}")
    for c, vals in spec.accepted_values:
        lits = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in vals)
        out.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'accepted_values' AS test, COUNT_IF(NOT {c} IN ({lits})) AS failures FROM {src}")
    for c in spec.unique:
        out.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'unique' AS test, COUNT(*) AS failures FROM (SELECT {c} FROM {src} "
                   f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)")
    return out
