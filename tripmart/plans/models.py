"""The transformation graph over the driver tables, as lazy DataFrames.

service file -> ingest -> typed raw table -> staging -> union -> fact -> marts.
Nothing is materialized unless a caller writes; Spark's plan is the DAG.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripmart.plans.adapters import RUN_1, service_raw, source_file_name, zones
from tripmart.plans.fact import build_fact
from tripmart.plans.ingest import ingest
from tripmart.plans.staging import stage, union_trips, unify
from tripmart.schemas import SERVICES, UNIONED
from tripmart.sources.load import to_table


def ingested(spark: SparkSession, sf_dir: str, service: str, stamp: str = RUN_1,
             split: bool = True, month: str | None = None, start: dt.datetime | None = None,
             end: dt.datetime | None = None, by_date: bool = False) -> DataFrame:
    s = SERVICES[service]
    return ingest(service_raw(spark, sf_dir, service, split, by_date), s, month=month,
                  source_file=source_file_name(service), ingested_at=stamp, start=start, end=end)


def raw_table(spark: SparkSession, sf_dir: str, service: str, stamp: str = RUN_1,
              split: bool = True) -> DataFrame:
    return to_table(ingested(spark, sf_dir, service, stamp, split), SERVICES[service])


def staged(spark: SparkSession, sf_dir: str, service: str, stamp: str = RUN_1,
           split: bool = True) -> DataFrame:
    return stage(raw_table(spark, sf_dir, service, stamp, split), SERVICES[service])


def unioned(spark: SparkSession, sf_dir: str, stamps: Sequence[str] = (RUN_1,)) -> DataFrame:
    out = None
    for stamp in stamps:
        u = union_trips({s: staged(spark, sf_dir, s, stamp) for s in UNIONED})
        out = u if out is None else out.unionByName(u)
    return out


def unified(spark: SparkSession, sf_dir: str, service: str, stamp: str = RUN_1) -> DataFrame:
    return unify(staged(spark, sf_dir, service, stamp), service)


def fact(spark: SparkSession, sf_dir: str, stamps: Sequence[str] = (RUN_1,)) -> DataFrame:
    return build_fact(unioned(spark, sf_dir, stamps))


def zone_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones(spark, sf_dir)
