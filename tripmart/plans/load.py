"""Q5: a service's typed raw table from its lake.

``run_load`` creates or replaces the table from all files; where these hold few dates each, as ingest writes them, it shuffles
no rows. ``copy_files`` loads each file once: a ledger
beside the table records every file it has seen (path, length, time of its last change, hash of its
content, load, verdict), and only files that the ledger does not know in that state are read. A changed
file replaces its own rows; one that was delivered again with the same content replaces nothing. The table
then keeps each row's file in the column ``_file``, which ``read_table`` leaves out.

Both read a file once (``sources.load.stage_files``) and return the report per file. Files that fail are
left out and reported; in the ledger they wait until they change (their earlier rows, if any, stay).

Only dates that a load touches are rewritten: those of the new rows, and those that hold rows of a changed
file. The rows are written before the ledger, so a load that was cut short is simply done again: its files
are still pending, and replacing a file's own rows twice gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.operators.upsert import read_if_exists, replace_groups
from tripmart.schemas import SERVICES
from tripmart.session import drop_scratch, scratch_dir, shuffles_freed
from tripmart.sources.footers import file_footers
from tripmart.sources.load import FILE, HASH, MISFIT, good_rows, load_raw, stage_files
from tripmart.sources.sinks import laid_out, write_as_laid_out, write_partitioned

LEDGER = """path string, length long, modified timestamp, content_hash long, footer_rows long, read_rows long, status string,
            load_id long"""
REPORT = ("path", "length", "footer_rows", "read_rows", "status")


def _footers(spark: SparkSession, lake: str) -> DataFrame:
    path = scratch_dir(spark, "footers")
    file_footers(spark, lake).drop("columns").write.parquet(path)
    return spark.read.parquet(path)


def run_load(spark: SparkSession, lake: str, service: str, table_path: str,
             skip_bad_files: bool = True) -> DataFrame:
    """Create or replace the table at ``table_path``; the report per file. With ``skip_bad_files=False`` a file that can't be
    read, or a value that doesn't fit, is an error."""
    s = SERVICES[service]
    if not skip_bad_files:
        write_partitioned(load_raw(spark, lake, s), table_path, "pickup_date", overwrite_scope="static")
        return _footers(spark, lake).select("path", "length", F.col("rows").alias("footer_rows"), F.col("rows").alias("read_rows"),
                                            F.lit("ok").alias("status"), F.lit(True).alias("loaded"))
    copy = scratch_dir(spark, "staged")
    with shuffles_freed(spark):
        staged, files = stage_files(spark, lake, s, _footers(spark, lake), hashed=False, staged=copy)
        good = good_rows(staged, files)
        write = write_as_laid_out if good is staged and laid_out(staged) else write_partitioned
        write(good.drop(FILE, HASH, MISFIT), table_path, "pickup_date", overwrite_scope="static")
    drop_scratch(spark, copy)
    return files.select(*REPORT).withColumn("loaded", F.col("status") == "ok")


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The latest entry of every file."""
    entries = read_if_exists(spark, ledger_path)
    if entries is None:
        return spark.createDataFrame([], LEDGER)
    latest = Window.partitionBy("path").orderBy(F.desc("load_id"))
    return entries.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def read_table(spark: SparkSession, table_path: str, service: str) -> DataFrame:
    return spark.read.parquet(table_path).select(*[f.name for f in SERVICES[service].table.fields])


def copy_files(spark: SparkSession, lake: str, service: str, table_path: str, ledger_path: str) -> DataFrame:
    """Load what the ledger does not know yet; the report of the files of this load: its columns are those of ``run_load``,
    and status may be 'unchanged' (delivered again with the same content). Nothing is written if no file is new."""
    s = SERVICES[service]
    ledger = read_ledger(spark, ledger_path)
    known = ledger.select("path", "length", "modified")
    pending_path = scratch_dir(spark, "pending")
    _footers(spark, lake).join(known, ["path", "length", "modified"], "left_anti").write.parquet(pending_path)
    pending = spark.read.parquet(pending_path)
    oldest = pending.agg(F.date_format(F.min("modified") - F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    if oldest is None:
        return spark.createDataFrame([], "path string, length long, footer_rows long, read_rows long, status string, loaded boolean")
    staged, found = stage_files(spark, lake, s, pending, modified_after=oldest)
    before = ledger.where("status IN ('ok', 'unchanged')").select("path", F.col("content_hash").alias("_before"), F.col("read_rows").alias("_rows"))
    entries_path = scratch_dir(spark, "entries")
    (found.join(before, "path", "left")
          .withColumn("status", F.expr("IF(status = 'ok' AND content_hash = _before AND read_rows = _rows, 'unchanged', status)"))
          .withColumn("replaces", F.expr("status = 'ok' AND _before IS NOT NULL")).drop("_before", "_rows").write.parquet(entries_path))
    entries = spark.read.parquet(entries_path)
    replace_groups(spark, table_path, good_rows(staged, entries).drop(HASH, MISFIT), FILE,
                   entries.where("replaces").select(F.col("path").alias(FILE)), "pickup_date")
    load_id = ledger.agg(F.coalesce(F.max("load_id"), F.lit(0)) + 1).first()[0]
    entries.select("path", "length", "modified", "content_hash", "footer_rows", "read_rows", "status",
                   F.lit(load_id).cast("long").alias("load_id")).write.mode("append").parquet(ledger_path)
    report = spark.read.schema(LEDGER).parquet(ledger_path).where(F.col("load_id") == load_id)
    for path in (pending_path, entries_path):
        drop_scratch(spark, path)
    return report.select(*REPORT, F.col("status").isin("ok", "unchanged").alias("loaded"))
