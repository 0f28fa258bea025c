"""K5/J2 on a co-partitioned target: keyed upsert into a table bucketed by its key inside date partitions.

The table is a catalog table, ``PARTITIONED BY (date) CLUSTERED BY (key) SORTED BY (key) INTO n BUCKETS``. Rows
of equal keys lie in equally numbered buckets, so the anti-join of the target with a batch reads the target's
buckets as they are: only the batch is shuffled, to n partitions by its key, and of the target only the touched
dates are read and rewritten. A hot date is spread over its n buckets. ``n`` is fixed when the table is made:
take the rows that a run touches divided by what one task should sort, since a run has n tasks a side.

The batch's distinct dates go to the driver as a partition filter: one value per date folder, of which the
driver holds the listing in any case. Like ``operators/upsert.py`` it takes a key to live in one date, NULL
dates are a partition, the batch is written aside first, and a run that is done again gives the same table.

``declare`` names an existing folder in a session whose catalog does not know it; with a catalog that outlives
the session it does nothing but look for new folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import drop_scratch, scratch_dir


def declare(spark: SparkSession, table: str, path: str, schema, buckets: int, key: str = "trip_id",
            partition_col: str = "pickup_date") -> None:
    """The table at ``path`` under the name ``table``; made empty where there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
              f"PARTITIONED BY (`{partition_col}`) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {int(buckets)} BUCKETS "
              f"LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def _touched(target: DataFrame, batch: DataFrame, partition_col: str) -> DataFrame:
    """The target's rows of the batch's dates, by a partition filter of literals."""
    dates = [r[0] for r in batch.select(partition_col).distinct().collect()]
    p = F.col(partition_col)
    known = [d for d in dates if d is not None]
    return target.where((p.isin(known) if known else F.lit(False)) | (p.isNull() if None in dates else F.lit(False)))


def kept_rows(spark: SparkSession, table: str, batch: DataFrame, key: str = "trip_id", partition_col: str = "pickup_date",
              computed: dict[str, Column] | None = None) -> DataFrame:
    """What the touched dates keep: their rows whose key is not in ``batch`` (a written table; ``computed`` columns follow
    from its others)."""
    target = spark.table(table)
    keys = batch.select((computed or {}).get(key, F.col(key)).alias(key), partition_col)
    p = F.col(partition_col)
    low, high = (target.select(f(p)).scalar() for f in (F.min, F.max))
    keys = keys.where(p.between(low, high) | p.isNull()).select(key)  # a key lives in one date: others have no equals
    return _touched(target, batch, partition_col).join(keys, key, "left_anti").select(*target.columns)


def upsert_bucketed(spark: SparkSession, table: str, batch: DataFrame, buckets: int, key: str = "trip_id",
                    partition_col: str = "pickup_date", computed: dict[str, Column] | None = None) -> None:
    """Batch rows replace those of equal keys, others are added. ``buckets`` is the table's number. ``computed`` are columns
    that follow from the batch's, which comes without them: neither its copy nor its shuffle carries them."""
    computed = computed or {}
    columns = spark.table(table).columns  # the partition column last
    given = [c for c in columns if c not in computed]
    slot = F.pmod(F.hash(computed.get(key, F.col(key))), F.lit(int(buckets)))

    def placed(rows: DataFrame) -> DataFrame:
        # A task per date and bucket writes the batch's files: the expression is that of the buckets.
        return rows.select(*given).repartition(F.col(partition_col), slot).withColumns(computed).select(*columns)

    if spark.table(table).isEmpty():  # the batch is the table: one pass
        placed(batch).write.insertInto(table, overwrite=True)
        spark.catalog.refreshTable(table)
        return
    staged = scratch_dir(spark, "bucketed-batch")
    batch.select(*given).write.parquet(staged)
    new = spark.read.schema(batch.select(*given).schema).parquet(staged)
    kept = kept_rows(spark, table, new, key, partition_col, computed)
    kept.unionByName(placed(new)).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    drop_scratch(spark, staged)
