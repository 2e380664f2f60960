"""A log of row changes, read as of any version.

Each change carries its key, its version, its place among the changes of the version, and
whether it deletes. The state at a version is the last change of every key up to it. A
stored log lies in a folder per version and time, so a reader of an early state lists and
reads the early versions only.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.rows import pick_per_key

# What a change carries beside the row.
CHANGE_COLUMNS = ["version", "operation", "committed_at", "place"]


def change(rows: DataFrame, version: int, operation: str, at: datetime, place: Column | int = 0) -> DataFrame:
    """Rows as the changes of one version; operation 'delete' takes their keys away.

    `place` orders the changes of a version: of two changes of a key the one with the greater
    place is the later.
    """
    return rows.withColumns(
        {
            "version": F.lit(version),
            "operation": F.lit(operation),
            "committed_at": F.lit(at).cast("timestamp"),
            "place": (place if isinstance(place, Column) else F.lit(place)).cast("long"),
        }
    )


def append_changes(changes: DataFrame, folder: str) -> None:
    """Store changes in a folder per version; a large version is several files."""
    dealt = changes.hint("rebalance", "version", "committed_at")
    dealt.write.mode("append").partitionBy("version", "committed_at").parquet(folder)


def stored_changes(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A stored log; conditions on version and time choose folders."""
    return spark.read.schema(schema).parquet(folder).select(*schema.names)


def _last_per_key(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last change of each key. Two at the very same place: the greater row, whichever way they are read."""
    rest = [c for c in changes.columns if c not in keys]
    order = F.struct("version", "place", F.struct(*(c for c in rest if c not in ("version", "place"))))
    return pick_per_key(changes, keys, lambda row: F.max_by(row, order)).select(*changes.columns)


def state(changes: DataFrame, keys: list[str], upto: Column | None = None) -> DataFrame:
    """The rows that stand after the changes `upto` chooses, or after all of them."""
    chosen = changes if upto is None else changes.where(upto)
    alive = _last_per_key(chosen, keys).where("operation <> 'delete'")
    return alive.drop(*CHANGE_COLUMNS)


def as_of_version(changes: DataFrame, keys: list[str], version: int) -> DataFrame:
    return state(changes, keys, F.col("version") <= version)


def as_of_time(changes: DataFrame, keys: list[str], moment: datetime) -> DataFrame:
    return state(changes, keys, F.col("committed_at") <= F.lit(moment).cast("timestamp"))


def history(changes: DataFrame) -> DataFrame:
    """Versions in order, with the number of rows each changed."""
    return (
        changes.groupBy("version", "operation", "committed_at")
        .agg(F.count("*").alias("rows_changed"))
        .orderBy("version", "operation")
    )


def squash(changes: DataFrame, keys: list[str], version: int) -> DataFrame:
    """The log without its history before a version: one change per key stands for it.

    States from that version on are what they were. Keys that are gone by then leave
    no trace.
    """
    old = F.col("version") <= version
    base = _last_per_key(changes.where(old), keys).where("operation <> 'delete'")
    return base.select(*changes.columns).unionByName(changes.where(~old))


def first_kept(changes: DataFrame, now: datetime, keep_days: int, keep_last: int) -> int | None:
    """The oldest version that retention leaves readable; None where nothing is to go.

    A version goes if it is older than `keep_days` and not among the `keep_last` newest,
    of which there must be one at least: without any, none goes.
    """
    versions = changes.groupBy("version").agg(F.max("committed_at").alias("committed_at"))
    protected = versions.orderBy(F.desc("version")).limit(keep_last).agg(F.min("version")).scalar()
    aged = F.col("committed_at") < F.lit(now - timedelta(days=keep_days)).cast("timestamp")
    gone = versions.where(aged & (F.col("version") < protected)).agg(F.max("version").alias("last"))
    after = versions.where(F.col("version") > gone.select("last").scalar()).agg(F.min("version"))
    return after.first()[0]


def expire(changes: DataFrame, keys: list[str], now: datetime, keep_days: int, keep_last: int) -> DataFrame:
    """The log squashed to the oldest version that retention keeps; as it is where none goes."""
    version = first_kept(changes, now, keep_days, keep_last)
    return changes if version is None else squash(changes, keys, version)
