"""The ingest -> fact flow as Structured Streaming jobs.

The reference runs a monthly batch job per service and an incremental fact
model. On Spark the same operators run as file-triggered streams:

* ``ingest_stream``: new monthly files in a landing folder -> the service's
  filters and derived columns -> the date-partitioned lake through the file
  sink (exactly-once via its commit log).
* ``fact_stream``: new lake files of the unioned services -> typed table ->
  staging -> unified columns -> per micro-batch dedup + keyed upsert into the
  fact. The upsert is idempotent on ``trip_id``, so a replayed batch after a
  failure rewrites the same rows.

Both use ``trigger(availableNow=True)`` by default (process what is there,
then stop), and keep their checkpoints below the shared checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripmart.plans.fact import build_fact, fact_columns
from tripmart.plans.ingest import ingest
from tripmart.plans.staging import stage, unify
from tripmart.schemas import SERVICES
from tripmart.session import checkpoint_root
from tripmart.operators.upsert import upsert
from tripmart.sources.load import to_table


def _checkpoint(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_root(spark), "tripmart-streams", name)


def ingest_stream(spark: SparkSession, service: str, landing: str, lake: str,
                  month: str | None = None, source_file: str | None = None,
                  ingested_at: _dt.datetime | str | None = None, checkpoint: str | None = None,
                  available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    s = SERVICES[service]
    reader = spark.readStream.schema(s.raw).option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = ingest(reader.parquet(landing), s, month=month, source_file=source_file, ingested_at=ingested_at)
    w = (out.writeStream.format("parquet").partitionBy("pickup_date")
            .option("checkpointLocation", checkpoint or _checkpoint(spark, f"ingest-{service}"))
            .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(lake)


def _lake_schema(spark: SparkSession, service: str) -> StructType:
    """Schema of a service's lake files: exactly what ``ingest`` writes, in
    file types (e.g. bigint duration), taken from the ingest plan itself."""
    s = SERVICES[service]
    return ingest(spark.createDataFrame([], s.raw), s, source_file="").schema


def fact_stream(spark: SparkSession, lakes: dict[str, str], fact_path: str,
                checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    frames = []
    for service, path in lakes.items():
        raw = spark.readStream.schema(_lake_schema(spark, service)).parquet(path)
        frames.append(unify(stage(to_table(raw, SERVICES[service]), SERVICES[service]), service))
    unioned = frames[0]
    for f in frames[1:]:
        unioned = unioned.unionByName(f)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, fact_path, fact_columns(build_fact(batch)), "trip_id", "pickup_date")

    w = (unioned.writeStream.foreachBatch(upsert_batch)
                .option("checkpointLocation", checkpoint or _checkpoint(spark, "fact")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
