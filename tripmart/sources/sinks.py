"""Writers: partitioned datasets, tables, views.

Partitioned writes go through a ``rebalance`` hint on the partition column:
AQE splits a skewed day (a single date holding a large share of rows) into
advisory-size pieces written by several tasks instead of one straggler,
without a sampling pass. Files that are laid out by the column already need no shuffle (``laid_out``,
``write_as_laid_out``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.session import settings

SMALL = 1 << 18  # bytes of a file, on average, that is still worth no shuffle


def write_partitioned(df: DataFrame, path: str, partition_col: str = "pickup_date",
                      mode: str = "overwrite", overwrite_scope: str = "dynamic",
                      max_records_per_file: int | None = None, rebalance: bool = True,
                      computed: dict[str, Column] | None = None) -> None:
    """K1: Parquet partitioned by ``partition_col``. ``overwrite_scope`` is
    'dynamic' (replace only the partitions present in ``df``) or 'static'
    (the reference's behaviour: replace the whole dataset). ``rebalance=False``
    when the caller already rebalanced on ``partition_col``. ``computed`` columns follow from
    the others: they are made behind the rebalance, so it does not carry them, and come first."""
    df = df.hint("rebalance", partition_col) if rebalance else df
    if computed:
        df = df.select(*[c.alias(name) for name, c in computed.items()], *[x for x in df.columns if x not in computed])
    w = (df.write.mode(mode)
           .option("partitionOverwriteMode", overwrite_scope).partitionBy(partition_col))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def laid_out(files: DataFrame, partition_col: str = "pickup_date") -> bool:
    """Whether written rows, partitioned file by file, make at most twice as many files as there are partitions, beside one
    for each file, or files of ``SMALL`` bytes at least: then a shuffle before a partitioned write of them gains little."""
    pairs = files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                         F.col(partition_col).alias("part")).distinct()
    n = pairs.groupBy("file").agg(F.count("*").alias("pairs"), F.max("size").alias("size")).agg(
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    return n.pairs <= max(2 * files.select(partition_col).distinct().count() + n.files, n.size // SMALL)


def write_as_laid_out(files: DataFrame, path: str, partition_col: str = "pickup_date", **how) -> None:
    """``write_partitioned`` of such files, without a shuffle and a file (or a piece of one) to a task, which sorts its rows."""
    spark = files.sparkSession
    with settings(spark, {"spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes")}):
        write_partitioned(files, path, partition_col, rebalance=False, **how)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2/K4: table materialization as an overwritten Parquet dataset."""
    df.write.mode(mode).parquet(path)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """K3: view materialization: a named, still-lazy plan."""
    df.createOrReplaceTempView(name)
    return df
