"""What the footers of a dataset's files say, read by the tasks that hold the listing.

Spark lists the files (path, length and time only); each task opens the footers of its share and gives
one row a file, which Spark joins and groups like any other rows. No path reaches the driver, a file
that can't be read is a row with an error, and any number of odd files takes the same one job. Where
the root's store is one that only Hadoop's file systems can open, the tasks get the files' bytes from
Spark instead.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stores whose files Arrow can open by itself.
OPENED = ("file", "s3", "gs", "gcs", "hdfs", "abfs", "abfss")
SCHEMA = """path string, length long, modified timestamp, rows long,
            columns array<struct<name: string, type: string>>, error string"""


def _scheme(spark: SparkSession, root: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()


def file_footers(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """One row per file below ``root``: path (as ``_metadata.file_path`` has it), length, time of its last
    change, rows, columns with their Spark types, or the error that its footer gives. Files of no bytes are not listed."""
    opened = _scheme(spark, root).replace("s3a", "s3").replace("s3n", "s3") in OPENED
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root)
    listing = listing.select(F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified"),
                             (F.col("path") if opened else F.col("content")).alias("at"))

    # A closure with its own imports: the tasks need no package of ours.
    def read(batches: Iterator) -> Iterator:
        import re

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_type

        def opened_file(at):
            if isinstance(at, bytes):
                return pa.BufferReader(at)
            local = re.match(r"file:/*(/.*)$", at)
            if local:
                return local[1]
            scheme, store, rest = re.match(r"([a-z0-9]+)://([^/]*)(/.*)$", at).groups()
            if scheme in ("s3a", "s3n", "s3", "gs", "gcs"):
                where, _ = fs.FileSystem.from_uri(f"{'s3' if scheme.startswith('s3') else 'gs'}://{store}")
                return where.open_input_file(store + rest)
            where, _ = fs.FileSystem.from_uri(f"{scheme}://{store}/")
            return where.open_input_file(rest)

        def spark_type(field, physical):
            if physical == "INT96":
                return "timestamp"
            try:
                return from_arrow_type(field.type, prefer_timestamp_ntz=True).simpleString()
            except Exception:
                return str(field.type)

        kinds = [pa.int64(), pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])), pa.string()]
        for batch in batches:
            found = []
            for at in batch.column(3).to_pylist():
                try:
                    with pq.ParquetFile(opened_file(at)) as f:
                        physical = {c.path: c.physical_type for c in map(f.schema.column, range(len(f.schema)))}
                        found.append((f.metadata.num_rows, [{"name": x.name, "type": spark_type(x, physical.get(x.name))}
                                                            for x in f.schema_arrow], None))
                except Exception as e:
                    found.append((None, None, f"{type(e).__name__}: {e}"[:300]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array([x[i] for x in found], k) for i, k in enumerate(kinds)]],
                names=["path", "length", "modified", "rows", "columns", "error"])

    return listing.mapInArrow(read, SCHEMA)


def compare_columns(footers: DataFrame, declared) -> DataFrame:
    """(column_name, type, declared_type, status) of all files' columns against a declared schema (or None): 'ok', 'type
    differs' (in any file; ``type`` then lists all), 'missing in files' or 'not declared'."""
    found = footers.select("path", F.explode("columns").alias("c")).groupBy(F.lower("c.name").alias("key")).agg(
        F.min_by("c.name", "path").alias("name"), F.array_join(F.array_sort(F.collect_set("c.type")), ", ").alias("type"))
    if declared is None:
        return found.select(F.col("name").alias("column_name"), "type", F.lit(None).cast("string").alias("declared_type"),
                            F.lit("ok").alias("status"))
    want = footers.sparkSession.createDataFrame(
        [(f.name.lower(), f.name, f.dataType.simpleString()) for f in declared.fields], "key string, given string, declared_type string")
    return found.join(want, "key", "full").select(
        F.coalesce("name", "given").alias("column_name"), "type", "declared_type",
        F.when(F.col("type").isNull(), "missing in files").when(F.col("declared_type").isNull(), "not declared")
        .when(F.col("type") == F.col("declared_type"), "ok").otherwise("type differs").alias("status"))
