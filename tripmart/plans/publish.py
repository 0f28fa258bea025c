"""Write, audit, publish: a model's new version is read by others only after its declared tests passed.

Every version is a table of its own below ``root/<model>/v<number>``. A version is written, tested as it
was written, and entered into the log ``root/_versions`` with its failures; it is published if there are
none. Readers (``current``) take the latest published version, so a failing build changes nothing for
them and a reader that began before a publication goes on with the files that it began with. In a
session's catalog the model is a view over that version, replaced in one step.

``publish_upsert`` does the same for a keyed batch without copying the table: the new content of the
touched partitions is written aside and tested with them as its scope (a key lives in one partition, so
uniqueness in the touched ones is uniqueness of the table if it held before), and only then takes their
place.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.quality import ModelTests, run_model_tests
from tripmart.operators.upsert import merged_partitions, read_if_exists
from tripmart.session import drop_scratch, scratch_dir
from tripmart.sources.sinks import write_partitioned, write_table

LOG = "model string, version long, path string, failures array<struct<column_name: string, test: string, failures: long>>, published boolean"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The log: a row per version ever built."""
    log = read_if_exists(spark, os.path.join(root, "_versions"))
    return spark.createDataFrame([], LOG) if log is None else log


def current_path(spark: SparkSession, root: str, model: str) -> str:
    """Where the latest published version of a model is."""
    path = versions(spark, root).where((F.col("model") == model) & F.col("published")).agg(F.max_by("path", "version")).first()[0]
    if path is None:
        raise LookupError(f"no version of {model} was published")
    return path


def current(spark: SparkSession, root: str, model: str) -> DataFrame:
    """The latest published version of a model."""
    return spark.read.parquet(current_path(spark, root, model))


def _failures(df: DataFrame, spec: ModelTests | None) -> list:
    """The tests that failed (a row per declared test at most)."""
    if spec is None:
        return []
    found = run_model_tests(df, spec).where("failures > 0").orderBy("column_name", "test").collect()
    return [(r.column_name, r.test, r.failures) for r in found]


def publish(spark: SparkSession, root: str, model: str, df: DataFrame, spec: ModelTests | None = None, view: str | None = None) -> bool:
    """Build a new version of ``model`` and publish it if its tests pass; whether they did. ``view`` names a catalog view."""
    number = versions(spark, root).where(F.col("model") == model).agg(F.coalesce(F.max("version"), F.lit(0)) + 1).first()[0]
    path = os.path.join(root, model, f"v{number}")
    write_table(df, path)
    failed = _failures(spark.read.parquet(path), spec)
    spark.createDataFrame([(model, number, path, failed, not failed)], LOG).write.mode("append").parquet(os.path.join(root, "_versions"))
    if not failed and view is not None:
        spark.sql(f"CREATE OR REPLACE VIEW `{view}` AS SELECT * FROM parquet.`{path}`")
    return not failed


def publish_upsert(spark: SparkSession, path: str, batch: DataFrame, spec: ModelTests, key: str = "trip_id",
                   partition_col: str = "pickup_date") -> list:
    """Upsert ``batch`` into the table at ``path`` if the touched partitions pass the tests with it; the failed tests
    (column, test, number), none if it was published."""
    aside = scratch_dir(spark, "audit")
    staged = scratch_dir(spark, "audit-batch")
    batch.write.parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    target = read_if_exists(spark, path)
    (batch if target is None else merged_partitions(target, batch, key, partition_col)).write.parquet(aside)
    new = spark.read.schema(batch.schema).parquet(aside)
    failed = _failures(new, spec)
    if not failed:
        write_partitioned(new, path, partition_col, overwrite_scope="dynamic")
    for made in (aside, staged):
        drop_scratch(spark, made)
    return failed
