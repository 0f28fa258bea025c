"""Seeds: small CSV reference tables with declared column types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import SEED_LENGTHS, SEEDS

# The four small seeds as shipped with the reference pipeline
# (vendor ids, rate codes, payment types, app-based license bases).
VENDORS = [(1, "Creative Mobile Technologies"), (2, "VeriFone Inc"), (3, "Unknown")]
RATE_CODES = [(1, "Standard rate"), (2, "JFK"), (3, "Newark"), (4, "Nassau or Westchester"),
              (5, "Negotiated fare"), (6, "Group ride")]
PAYMENT_TYPES = [(1, "Credit card"), (2, "Cash"), (3, "No charge"), (4, "Dispute"), (5, "Unknown"),
                 (6, "Voided trip")]
HVFHV_BASES = [("HV0002", "Juno/Gett", "App-based"), ("HV0003", "Uber", "App-based"),
               ("HV0004", "Via", "App-based"), ("HV0005", "Lyft", "App-based")]

BUILTIN = {"vendors": VENDORS, "rate_codes": RATE_CODES, "payment_types": PAYMENT_TYPES,
           "hvfhv_bases": HVFHV_BASES}


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Header CSV read with the seed's declared schema (no inference).
    Quoted fields keep their text ('N/A' stays a string); empty fields are NULL."""
    return (spark.read.option("header", True).option("mode", "FAILFAST")
                 .schema(SEEDS[name]).csv(path))


def builtin_seed(spark: SparkSession, name: str) -> DataFrame:
    """One of the four small fixed seeds as a DataFrame."""
    return spark.createDataFrame(BUILTIN[name], SEEDS[name])


def length_violations(df: DataFrame, name: str) -> DataFrame:
    """Rows breaking a declared ``varchar(n)`` length of the seed."""
    limits = SEED_LENGTHS.get(name, {})
    cond = F.lit(False)
    for c, n in limits.items():
        cond = cond | (F.length(F.col(c)) > n)
    return df.where(cond)
