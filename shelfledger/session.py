"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # texts are long: what a Python worker and its JVM hold of a batch is bounded by bytes, not by rows
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
    # the ids that a long-lived stream remembers outgrow the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: For tables whose texts are mostly ids: takes about half the bytes of the default codec.
DENSE = "zstd"


def session(app: str = "shelfledger", master: str | None = None, **conf) -> SparkSession:
    """Session with the engine's settings; keyword names use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that someone else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for derived tables, on the storage that every executor sees.

    The cluster names that storage in ``spark.checkpoint.dir``. A local temporary folder is
    used only in local mode with the setting absent; elsewhere that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.mkdtemp(prefix="shelfledger-"), name)


def stage(df: DataFrame, name: str = "stage", partition_by: str | None = None, codec: str | None = None,
          tasks: int | None = None) -> DataFrame:
    """Write a frame to the shared storage and read it back: it is computed once, and a lost
    executor takes nothing with it. ``codec`` compresses other than the session does; ``tasks`` is the most
    tasks that write it, a file each: Hadoop starts a process or more for every file that it creates on a local disk."""
    df = df.coalesce(tasks) if tasks else df
    path = scratch_dir(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer = writer.option("compression", codec) if codec else writer
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """In this block the shuffle files of an action are removed when it ends, and not when the driver happens to collect its garbage.
    What runs in it must not run an action on one and the same frame twice."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that the engine wrote, wherever Spark keeps it; nothing happens if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
