"""Session construction and the shared scratch location.

The scratch location is the shared folder named by ``spark.checkpoint.dir``;
it is only set here when a single-machine session has none, never overridden.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every tripmart job relies on. Shuffle width is left to the
# caller / cluster defaults except in local runs; AQE coalesces and
# splits partitions at runtime either way.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small shuffle partitions are merged only up to this size, so a date-partitioned write
    # keeps several writers.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.caseSensitive": "false",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tripmart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder. A session on one machine (``local`` masters) gets a folder of
    its own where none is set; on a cluster, whose executors couldn't see it, that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share: "
                               "written intermediate tables go there")
        root = tempfile.mkdtemp(prefix="tripmart-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root for written tables."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tripmart", f"{name}-{uuid.uuid4().hex[:12]}")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_dir`` gave, once no plan reads it any more."""
    if "/tripmart/" not in path or not path.startswith(checkpoint_root(spark)):
        raise ValueError(f"not a scratch folder: {path}")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Runtime settings that hold within it."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shuffles_freed(spark: SparkSession) -> contextlib.AbstractContextManager:
    """Within it, a query's shuffle files go when the query ends, not when the driver happens to collect its garbage."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def smaller_pieces(spark: SparkSession, times: int) -> contextlib.AbstractContextManager:
    """Within it, adaptive execution cuts shuffled data to pieces so many times smaller."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    return settings(spark, {key: f"{max(1, size // times)}b"})
