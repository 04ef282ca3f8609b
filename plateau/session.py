"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings of sessions created here. What depends on the cluster's size (broadcast threshold,
# shuffle partitions, memory) is left to its own defaults.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

_HELD: list[DataFrame] = []
_STORED: list[list[tuple[SparkSession, str]]] = [[], []]  # of the query before, of this one


def get_spark(master: str | None = None, app: str = "plateau",
              shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in extra.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is. A scratch folder is
    created only for a ``local`` master; anywhere else a missing setting is an error, as
    each machine would write to its own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="plateau-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_code() -> None:
    """Functions of this package travel to the executors by value: they need no copy of it."""
    import plateau
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(plateau)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job wrote for itself, wherever it is stored."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def ensure_utc(spark: SparkSession) -> None:
    """All calendar logic in this library is defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def hold(df: DataFrame) -> DataFrame:
    """Keep a derived input that several branches of one job read, on the executors' disks, until
    ``release``. Every held input is deterministic, so a lost block is recomputed to the same rows."""
    held = df.persist(StorageLevel.DISK_ONLY)
    _HELD.append(held)
    return held


def sweep(spark: SparkSession) -> None:
    """Have Spark delete the files of exchanges and checkpoints that nothing refers to any more; by itself it does so only
    when the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def store(df: DataFrame) -> DataFrame:
    """A derived input that several passes read, written once as Parquet in the shared checkpoint folder. Unlike what ``hold``
    keeps it needs nothing that led to it: the files of those exchanges go. The second ``release`` from here deletes it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED[-1].append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    del df
    sweep(spark)
    return out


def release() -> None:
    """Drop what ``hold`` keeps, and what ``store`` wrote before the last call. A frame built on what was held stays valid; it is
    recomputed if it runs again."""
    while _HELD:
        df = _HELD.pop()
        if df.sparkSession.sparkContext._jsc is not None:  # else its session has ended, and its blocks with it
            df.unpersist()
    for spark, path in _STORED.pop(0):
        if spark.sparkContext._jsc is not None:
            remove(spark, path)
    _STORED.append([])
