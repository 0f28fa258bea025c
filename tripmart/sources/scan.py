"""Scans: declared-schema Parquet reads, partitioned read-back, schema report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripmart.sources.footers import compare_columns, file_footers


def read_trips(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """Parquet scan with a declared schema (``StructType`` or DDL
    string). Names resolve case-insensitively (S3); absent columns read as
    NULL; only the columns a query uses are read."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).parquet(*paths)


def read_partitioned(spark: SparkSession, root: str, glob: str | None = "*.parquet") -> DataFrame:
    """Read back a ``col=value/`` dataset; partition columns are
    discovered (typed, e.g. ``date``) and prune directories when filtered."""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(root)


def schema_report(spark: SparkSession, path: str, declared: StructType | None = None) -> DataFrame:
    """(column_name, type) as found in all files, against a declared schema: status is 'ok',
    'type differs' (in any file; ``type`` then lists all), 'missing in files' or 'not declared'.
    Reads only footers, in the tasks."""
    return compare_columns(file_footers(spark, path), declared)
