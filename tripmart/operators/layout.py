"""Preview and partition-shape probes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """L1: first ``n`` rows; deterministic when ``order_by`` is given
    (a top-n: Catalyst plans TakeOrderedAndProject, no full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def partition_rows(df: DataFrame) -> DataFrame:
    """L2: rows per input partition."""
    return (df.groupBy(F.spark_partition_id().alias("partition_id"))
              .agg(F.count(F.lit(1)).alias("rows")))


def partition_skew(df: DataFrame) -> DataFrame:
    """L2 summary: number of non-empty partitions, total, max and mean rows."""
    return partition_rows(df).agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"),
                                  F.max("rows").alias("max_rows"), F.avg("rows").alias("mean_rows"))
