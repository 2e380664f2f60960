"""Session settings and the shared work area."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

# Settings that decide results or survive scale; sizes are left to the cluster.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Percentile sketches of up to so many groups a task are kept by hash; beyond, they are sorted.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # The older format of timestamps has no statistics, so a reader of a span of time would skip nothing.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Streaming state lies in RocksDB, within one bound per executor, and is saved as changes: it may outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Split a hot join key even if the next operator then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "orderloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Put the engine settings on a session somebody else built."""
    for key, value in ENGINE_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, else the warehouse.

    Where executors have machines of their own, a warehouse on a local disk is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or shared_warehouse(spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)).rstrip("/")


def shared_warehouse(folder: str, master: str) -> str:
    one_machine = master == "local" or master.startswith("local[")
    if not one_machine and urlsplit(folder).scheme in ("", "file"):
        raise ValueError(f"set spark.checkpoint.dir: {folder} is a local folder, and {master} has executors elsewhere")
    return folder


def work_area(spark: SparkSession, purpose: str) -> str:
    """A path of its own for one run's tables, checkpoints or streams."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
