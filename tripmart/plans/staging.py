"""Q6-Q7: staging views per service and the unified trip union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.projections import align, rename, union_aligned
from tripmart.schemas import UNIFIED, UNIONED, Service

# Per-service source of each unified column when it is not the same name;
# None = not provided by that service (typed NULL).
UNIFIED_FROM = {
    "yellow": {"ehail_fee": None, "green_trip_type": None, "hvfhs_license_num": None,
               "driver_pay": None, "shared_request_flag": None, "shared_match_flag": None},
    "green": {"airport_fee": None, "hvfhs_license_num": None, "driver_pay": None,
              "shared_request_flag": None, "shared_match_flag": None},
    "hvfhv": {"vendor_id": None, "passenger_count": None, "trip_distance": "trip_miles",
              "rate_code_id": None, "store_and_fwd_flag": None, "payment_type": None,
              "extra": None, "mta_tax": None, "improvement_surcharge": None, "total_amount": None,
              "avg_speed_mph": None, "ehail_fee": None, "green_trip_type": None},
}


def stage(raw_table: DataFrame, service: Service) -> DataFrame:
    """Q6: rename to the standard names (P1/P4) and tag the service."""
    return rename(raw_table, service.staging).withColumn("trip_type", F.lit(service.name))


def unify(staged: DataFrame, service: str) -> DataFrame:
    """Project one staged service onto the 32-column unified schema."""
    return align(staged, UNIFIED, UNIFIED_FROM[service])


def union_trips(staged: dict[str, DataFrame], services: tuple[str, ...] = UNIONED) -> DataFrame:
    """Q7: UNION ALL of the unioned services (yellow, green, HVFHV); FHV is
    staged but deliberately not part of the union. ``services`` names what to
    union; a service without a staged frame is an error, never left out."""
    missing = [s for s in services if s not in staged]
    if missing:
        raise ValueError(f"no staged trips for {', '.join(missing)}")
    return union_aligned([unify(staged[s], s) for s in services])
