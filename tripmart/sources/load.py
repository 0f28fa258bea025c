"""Bulk load of written Parquet into a typed raw table, by column name.

* scan with the lake's declared file schema (declaring ``decimal`` over a
  ``double`` file fails, and inferring from one footer could miss columns of
  other files), then cast to the table type (S6, P10);
* match names case-insensitively; a column absent from the files is NULL;
* all ``*.parquet`` files below the root, at any depth (S7);
* ``pickup_date`` comes from the file's directory (``pickup_date=...``) and is
  back-filled from the pickup timestamp where NULL (K6), so no separate UPDATE
  pass exists;
* optionally skip unreadable files and report them (S8).

``stage_files`` is the load's one read of the files: every row is cast and
written to a staging area, marked where a value does not fit, with its file and
a hash of its raw values. Counts per file come from those three columns of the
staged copy, and with the footers' row counts they give each file's verdict. Only
rows of bad files are then set aside (an anti join, none where all are good).

``load_raw`` is the view of a lake without a table: it reads the files when it
is read, and where bad files are to be skipped it probes them first
(``file_health``: a count of rows per file from the footers, and one full read
whose count must match).
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.operators.projections import align
from tripmart.schemas import Service, lake_schema
from tripmart.session import scratch_dir
from tripmart.sources.footers import compare_columns, file_footers


def backfill_date(df: DataFrame, ts_col: str, date_col: str = "pickup_date") -> DataFrame:
    """K6: ``date_col = coalesce(date_col, to_date(ts_col))``."""
    if date_col not in df.columns:
        return df.withColumn(date_col, F.to_date(F.col(ts_col)))
    return df.withColumn(date_col, F.coalesce(F.col(date_col), F.to_date(F.col(ts_col))))


def file_health(spark: SparkSession, root: str, schema: StructType | None = None,
                glob: str = "*.parquet", target: StructType | None = None) -> DataFrame:
    """S8 probe: one row per listed file with ``footer_rows``, ``read_rows``,
    ``cast_failures`` and ``status`` in {'ok', 'no rows', 'unreadable',
    'partly unreadable', 'cast overflow'}. ``schema`` is the file schema to
    read with; ``target`` the table schema the load casts to: a non-NULL
    value that does not fit its target type flags the file."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                    .option("recursiveFileLookup", "true").load(root)
                    .select(F.col("_metadata.file_path").alias("path"), "length"))

    def reader() -> DataFrame:
        r = (spark.read.option("ignoreCorruptFiles", "true").option("pathGlobFilter", glob)
                  .option("recursiveFileLookup", "true"))
        return (r.schema(schema) if schema is not None else r).parquet(root)

    footer = (reader().select(F.col("_metadata.file_path").alias("path"))
                      .groupBy("path").agg(F.count(F.lit(1)).alias("footer_rows")))
    full = reader()
    row_hash = F.xxhash64(*[F.col(c) for c in full.columns])
    types = {f.name.lower(): f.dataType for f in (target.fields if target is not None else [])}
    misfit = F.lit(False)
    for c in full.columns:
        t = types.get(c.lower())
        if t is not None and t != full.schema[c].dataType:
            misfit = misfit | (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
    read = (full.select(F.col("_metadata.file_path").alias("path"), row_hash.alias("h"), misfit.alias("m"))
                .groupBy("path").agg(F.count(F.lit(1)).alias("read_rows"),
                                     F.bit_xor("h").alias("content_hash"),
                                     F.count_if("m").alias("cast_failures")))
    out = listing.join(footer, "path", "left").join(read, "path", "left")
    # status reads content_hash (NULL exactly when read_rows is NULL): any
    # consumer of status therefore forces the full-column read. Were the
    # hash unused, Catalyst would prune it, read no data columns and report
    # every readable footer as ok.
    status = (F.when(F.col("footer_rows").isNull() & F.col("content_hash").isNull(), "no rows")
               .when(F.col("content_hash").isNull(), "unreadable")
               .when(F.col("read_rows") < F.col("footer_rows"), "partly unreadable")
               .when(F.col("cast_failures") > 0, "cast overflow")
               .otherwise("ok"))
    return out.withColumn("status", status)


def probe(spark: SparkSession, root: str, service: Service, glob: str = "*.parquet") -> DataFrame:
    """``file_health`` with the service's file schema and table types, written once."""
    path = scratch_dir(spark, "file-health")
    file_health(spark, root, lake_schema(service), glob, target=service.table).write.parquet(path)
    return spark.read.parquet(path)


def load_raw(spark: SparkSession, root: str, service: Service, skip_bad_files: bool = False,
             glob: str = "*.parquet", health: DataFrame | None = None) -> DataFrame:
    """Q5: the typed raw table of one service from its written dataset. ``health`` is the result of
    ``probe`` where the caller has one."""
    src = (spark.read.schema(lake_schema(service)).option("pathGlobFilter", glob)
                .option("recursiveFileLookup", "true"))
    if skip_bad_files:
        src = src.option("ignoreCorruptFiles", "true")
    file_path = F.col("_metadata.file_path")
    folder = F.url_decode(F.regexp_extract(file_path, "/pickup_date=([^/]+)/", 1))
    df = src.parquet(root).withColumns({"_path": file_path, "_folder_date": folder.try_cast("date")})
    if skip_bad_files:
        health = probe(spark, root, service, glob) if health is None else health
        bad = health.where(~F.col("status").isin("ok", "no rows")).select(F.col("path").alias("_bad_path"))
        if not bad.isEmpty():
            df = df.join(bad, F.col("_path") == F.col("_bad_path"), "left_anti")
    return to_table(df.withColumnRenamed("_folder_date", "pickup_date"), service)


STAGED_ROWS = 1_000_000  # of one staged file at most: what a task sorts where the copy is written on as it lies
FILE, HASH, MISFIT = "_file", "_hash", "_misfit"  # columns of staged rows beside the table's


def stage_files(spark: SparkSession, root: str, service: Service, footers: DataFrame, glob: str = "*.parquet",
                modified_after: str | None = None, hashed: bool = True, staged: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of the files below ``root`` that ``footers`` lists (of ``file_footers``), read once, cast and written to a
    staging area; and a written row per file: path, length, modified, footer_rows, read_rows, cast_failures, content_hash
    and status ('ok', 'no rows', 'unreadable', 'partly unreadable', 'cast overflow'). ``modified_after`` keeps the scan
    from files that have not changed since. Without ``hashed`` no content hash is made (it is NULL), nor carried by the copy.
    ``staged`` is the staging area's folder, where the caller removes it."""
    src = (spark.read.schema(lake_schema(service)).option("ignoreCorruptFiles", "true").option("pathGlobFilter", glob)
                .option("recursiveFileLookup", "true"))
    if modified_after is not None:
        src = src.option("modifiedAfter", modified_after)
    raw = src.parquet(root)
    path = F.col("_metadata.file_path")
    folder = F.url_decode(F.regexp_extract(path, "/pickup_date=([^/]+)/", 1)).try_cast("date")
    misfit = [F.col(f.name).isNotNull() & F.col(f.name).try_cast(t.dataType).isNull()
              for f in raw.schema.fields for t in service.table.fields
              if t.name.lower() == f.name.lower() and t.dataType != f.dataType]
    row_hash = F.xxhash64(F.col("_metadata.row_index"), *raw.columns) if hashed else F.lit(None).cast("long")
    rows = raw.withColumns({FILE: path, "pickup_date": folder, HASH: row_hash,
                            MISFIT: F.coalesce(functools.reduce(operator.or_, misfit, F.lit(False)), F.lit(False))})
    if modified_after is not None:
        rows = rows.join(footers.select(F.col("path").alias(FILE)), FILE, "left_semi")
    table = backfill_date(align(rows, service.table, also=(FILE, HASH, MISFIT), lenient=True), service.pickup)
    staged, verdict = staged or scratch_dir(spark, "staged"), scratch_dir(spark, "verdicts")
    table.write.option("maxRecordsPerFile", STAGED_ROWS).parquet(staged)
    table = spark.read.schema(table.schema).parquet(staged)
    read = table.groupBy(F.col(FILE).alias("path")).agg(
        F.count(F.lit(1)).alias("read_rows"), F.bit_xor(HASH).alias("content_hash"), F.count_if(MISFIT).alias("cast_failures"))
    files = footers.select("path", "length", "modified", F.col("rows").alias("footer_rows")).join(read, "path", "left")
    files.withColumn("status", F.expr("""CASE WHEN read_rows IS NULL AND coalesce(footer_rows, 0) = 0 THEN 'no rows'
        WHEN read_rows IS NULL THEN 'unreadable' WHEN read_rows < footer_rows THEN 'partly unreadable'
        WHEN cast_failures > 0 THEN 'cast overflow' ELSE 'ok' END""")).write.parquet(verdict)
    return table, spark.read.parquet(verdict)


def good_rows(staged: DataFrame, files: DataFrame, status: str = "ok") -> DataFrame:
    """The staged rows of the files with that status."""
    bad = files.where((F.col("status") != status) & F.col("read_rows").isNotNull()).select(F.col("path").alias(FILE))
    return staged if bad.isEmpty() else staged.join(bad, FILE, "left_anti").select(*staged.columns)


def to_table(df: DataFrame, service: Service) -> DataFrame:
    """By-name, case-insensitive projection onto the typed raw table, then
    the ``pickup_date`` back-fill (S6, P10, K6)."""
    return backfill_date(align(df, service.table), service.pickup)


def post_load_check(spark: SparkSession, root: str, declared: StructType) -> DataFrame:
    """The checks run after a load, as one row: the row count (of the footers,
    no data columns read) and how the files' columns compare with the
    declared table (S9 summarized)."""
    path = scratch_dir(spark, "footers")
    file_footers(spark, root).write.parquet(path)
    footers = spark.read.parquet(path)

    def n(condition: str):
        return F.count_if(F.expr(condition))

    return compare_columns(footers, declared).agg(
        footers.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).scalar().alias("rows"),
        n("type IS NOT NULL").cast("int").alias("columns_in_files"),
        n("status = 'missing in files'").cast("int").alias("columns_missing"),
        n("status = 'type differs'").cast("int").alias("columns_type_differs"),
        n("status = 'not declared'").cast("int").alias("columns_not_declared"))
