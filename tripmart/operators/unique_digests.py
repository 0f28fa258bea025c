"""T2 kept up to date: a unique test that reads the rows of touched dates only.

Beside the table lies its state. ``digests`` has a row per date and key, the key's 64-bit hash and its
number of rows, partitioned by date like the table; ``clashes`` has the hashes that more than one row of
the table shares. A run makes the digests of touched dates anew, and looks up in all digests only the
hashes of those dates and the earlier clashes: no other hash can have become a clash or ceased to be one.
That reads sixteen bytes a key of the untouched dates and none of their rows. Unequal keys of one hash are
told apart at the end: rows with a clashing hash, in the dates that hold one, are counted by their key.

Dates go to the driver as partition filters: one value per date folder, of which it holds the listing in
any case. NULL keys are left out, as in the plain test; NULL dates are a partition. A date that lost its
rows loses its digests. Clashes are replaced after the digests and only ever looked up with them, so a
run cut short is done again with the same touched dates.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.quality import unique_violations
from tripmart.operators.upsert import drop_partition, read_if_exists
from tripmart.session import drop_scratch, scratch_dir
from tripmart.sources.sinks import write_partitioned, write_table


def _in_dates(df: DataFrame, dates: list, partition_col: str) -> DataFrame:
    p = F.col(partition_col)
    known = [d for d in dates if d is not None]
    return df.where((p.isin(known) if known else F.lit(False)) | (p.isNull() if None in dates else F.lit(False)))


def _dates(df: DataFrame, partition_col: str) -> list:
    return [r[0] for r in df.select(partition_col).distinct().collect()]


def key_digests(rows: DataFrame, key: str, partition_col: str) -> DataFrame:
    """(partition, hash, n_records) of the keys that are not NULL."""
    return rows.where(F.col(key).isNotNull()).groupBy(partition_col, F.xxhash64(key).alias("hash")).agg(
        F.count(F.lit(1)).alias("n_records"))


def _refresh_digests(spark: SparkSession, table: DataFrame, path: str, touched: list | None, key: str, partition_col: str) -> None:
    if touched is None:
        write_partitioned(key_digests(table, key, partition_col), path, partition_col, overwrite_scope="static")
        return
    new = key_digests(_in_dates(table, touched, partition_col), key, partition_col)
    write_partitioned(new, path, partition_col, overwrite_scope="dynamic")
    held = _dates(_in_dates(table.where(F.col(key).isNotNull()), touched, partition_col), partition_col)
    for date in set(touched) - set(held):
        drop_partition(spark, path, partition_col, date)


def duplicated_keys(spark: SparkSession, path: str, state: str, touched: DataFrame | None = None, key: str = "trip_id",
                    partition_col: str = "pickup_date") -> DataFrame:
    """(key, n_records) of all keys that the table at ``path`` holds more than once. ``touched`` has the dates written
    since the state at ``state`` was brought up to date; without it, or without a state, all are."""
    table = spark.read.parquet(path)
    digests_path, clashes_path = os.path.join(state, "digests"), os.path.join(state, "clashes")
    before = read_if_exists(spark, clashes_path)
    dates = None if touched is None or before is None else _dates(touched, partition_col)
    _refresh_digests(spark, table, digests_path, dates, key, partition_col)
    digests = spark.read.schema(key_digests(table, key, partition_col).schema).parquet(digests_path)
    scope = digests
    if dates is not None:
        wanted = _in_dates(digests, dates, partition_col).select("hash").unionByName(before.select("hash")).distinct()
        scope = digests.join(wanted, "hash", "left_semi")
    aside = scratch_dir(spark, "clashes")
    scope.groupBy("hash").agg(F.sum("n_records").alias("n")).where("n > 1").select("hash").write.parquet(aside)
    clashes = spark.read.schema("hash long").parquet(aside)
    write_table(clashes, clashes_path)
    drop_scratch(spark, aside)
    clashes = spark.read.schema("hash long").parquet(clashes_path)
    held = _dates(digests.join(clashes, "hash", "left_semi"), partition_col)
    rows = _in_dates(table, held, partition_col).select(key)
    return unique_violations(rows.join(clashes, F.xxhash64(key) == F.col("hash"), "left_semi"), key)
