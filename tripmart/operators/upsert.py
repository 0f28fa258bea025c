"""Keyed incremental upsert into a date-partitioned Parquet dataset.

MERGE semantics on ``key`` (matched -> replaced by the batch row, unmatched
-> inserted) restricted to the partitions the batch touches:

    kept   = target  ⋉ dates(batch)          (null-safe semi join on the date)
                     ▷ keys(batch)            (left anti join on key)
    output = kept ∪ batch   -> dynamic partition overwrite

Only touched partitions are rewritten. The batch is first written to the
shared checkpoint folder so the three uses below read one materialized copy
(and an executor loss never recomputes the upstream); the copy is removed at
the end. The distinct dates are a small table that adaptive execution
broadcasts; the batch's first and last date, as scalar subqueries, prune the
target's directories before that. There is one path for any number of dates,
NULL included. Requires that a key lives
in exactly one partition (the trip key contains the pickup timestamp, whose
date is the partition value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tripmart.session import drop_scratch, scratch_dir
from tripmart.sources.sinks import write_partitioned


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The dataset at ``path``; None where there is no such folder or no file in it. Files that can't be read are an error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(where):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        files = store.listFiles(where, True)
        while files.hasNext():
            if files.next().getPath().getName().endswith(".parquet"):
                raise
        return None


def high_water_mark(target: DataFrame, column: str = "pickup_date") -> Column:
    """``(SELECT MAX(column) FROM target)`` as a scalar subquery; the
    partition column's max needs no data-file columns."""
    return target.select(F.max(column)).scalar()


def replace_groups(spark: SparkSession, path: str, batch: DataFrame, group: str, changed: DataFrame,
                   partition_col: str = "pickup_date") -> None:
    """Put the rows of ``batch`` into the dataset and take out what it holds of the same values of ``group`` (in the dates of
    the batch) and of those that ``changed`` lists (in all dates). Only touched dates are rewritten; a date that is left
    without rows is emptied."""
    target = read_if_exists(spark, path)
    if target is None:
        write_partitioned(batch, path, partition_col)
        return
    # Touched dates and groups are short lists; written aside, their sizes are known to the planner, which then need not
    # shuffle the target for them.
    p = F.col(partition_col)
    lists = [scratch_dir(spark, n) for n in ("gone", "touched", "groups")]

    def listed(df: DataFrame, where: str) -> DataFrame:
        df.distinct().write.parquet(where)
        return spark.read.schema(df.schema).parquet(where)

    dates, gone, emptied = batch.select(p.alias("_touched")), None, []
    if not changed.isEmpty():  # dates that hold rows of changed groups: two columns of the target are read
        gone = listed(target.join(changed, group, "left_semi").select(p.alias("_touched")), lists[0])
        dates = dates.unionByName(gone)
    dates = listed(dates, lists[1])
    groups = listed(batch.select(group).unionByName(changed.select(group)), lists[2])
    kept = target.join(dates, p.eqNullSafe(F.col("_touched")), "left_semi").join(groups, group, "left_anti")
    if gone is not None:
        left = kept.select(p.alias("_left")).unionByName(batch.select(p.alias("_left"))).distinct()
        emptied = [r[0] for r in gone.join(left, gone["_touched"].eqNullSafe(left["_left"]), "left_anti").collect()]  # dates
    write_partitioned(kept.select(*batch.columns).unionByName(batch), path, partition_col, overwrite_scope="dynamic")
    for value in emptied:
        drop_partition(spark, path, partition_col, value)
    for made in lists if gone is not None else lists[1:]:
        drop_scratch(spark, made)


def drop_partition(spark: SparkSession, path: str, column: str, value) -> None:
    """Remove the folder of one partition value (a date, or None)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path, f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def merged_partitions(target: DataFrame, batch: DataFrame, key: str = "trip_id", partition_col: str = "pickup_date",
                      also: dict[str, Column] | None = None) -> DataFrame:
    """What the partitions that ``batch`` (a written table) touches hold after it: its rows, and theirs of other keys. Columns
    of ``also`` follow from the batch's others; of its rows they are left NULL, and ``_new`` says which rows those are. Only
    the batch's keys in the target's range of dates are compared: a key lives in one partition."""
    p = F.col(partition_col)
    touched = batch.select(p.alias("_touched")).distinct()
    near = _in_range_of(target, batch, partition_col)
    scope = near.join(touched, F.col(partition_col).eqNullSafe(F.col("_touched")), "left_semi")
    keys = _in_range_of(batch, target, partition_col).select((also or {}).get(key, F.col(key)).alias(key))
    kept = scope.join(keys, key, "left_anti")
    if not also:
        return kept.select(*batch.columns).unionByName(batch)
    missing = [F.lit(None).cast(target.schema[c].dataType).alias(c) for c in also]
    return kept.select(*batch.columns, *also, F.lit(False).alias("_new")).unionByName(
        batch.select("*", *missing, F.lit(True).alias("_new")))


def _in_range_of(df: DataFrame, other: DataFrame, partition_col: str) -> DataFrame:
    """The rows of ``df`` from the first to the last date that ``other`` has, or without a date if ``other`` has such rows."""
    p = F.col(partition_col)
    low, high = (other.select(f(p)).scalar() for f in (F.min, F.max))
    return df.where(p.between(low, high) | (p.isNull() & other.where(p.isNull()).exists()))


def upsert(spark: SparkSession, path: str, batch: DataFrame, key: str = "trip_id",
           partition_col: str = "pickup_date", computed: dict[str, Column] | None = None, staged: bool = False) -> None:
    """K5 + J2. ``computed`` are columns that follow from the batch's, which comes without them: neither its copy nor
    a shuffle carries them. ``staged`` says that the batch is a written table already."""
    target = read_if_exists(spark, path)
    if target is None:  # first load: the batch is the table, written in one pass
        write_partitioned(batch, path, partition_col, computed=computed)
        return
    aside = None
    if not staged:
        aside = scratch_dir(spark, "upsert-batch")
        batch.write.mode("overwrite").parquet(aside)
        batch = spark.read.schema(batch.schema).parquet(aside)
    out = merged_partitions(target, batch, key, partition_col, computed)
    if not computed:
        write_partitioned(out, path, partition_col, overwrite_scope="dynamic")
    else:
        out = out.hint("rebalance", partition_col).withColumns(
            {name: F.when(F.col("_new"), c).otherwise(F.col(name)) for name, c in computed.items()})
        write_partitioned(out.select(*computed, *batch.columns), path, partition_col, overwrite_scope="dynamic", rebalance=False)
    if aside is not None:
        drop_scratch(spark, aside)
