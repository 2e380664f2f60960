"""File statistics, compaction, orphan files."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MEGABYTE = 1024 * 1024
# The nightly job's target size and least number of files, the
# on-demand job's least number, the days and versions that expiry keeps, and the
# age an orphan must have.
TARGET_BYTES = 128 * MEGABYTE
NIGHTLY_MIN_FILES = 5
ON_DEMAND_MIN_FILES = 2
KEEP_DAYS = 7
KEEP_LAST = 5
ORPHAN_DAYS = 3

FILES_PER_SHARE = 10_000  # files that are put into bins together


def file_statistics(df: DataFrame) -> DataFrame:
    """Path, rows and bytes of every data file under a frame.

    Only file metadata is selected, so the scan reads no column.
    """
    return (
        df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy("file_path")
        .agg(F.count("*").alias("rows"), F.max("bytes").alias("bytes"))
    )


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet files of a folder by name, size and time; their contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .select("path", "length", "modificationTime")
    )


def partition_statistics(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per partition; partition columns come from the paths, counts from the footers."""
    return df.groupBy(*columns).agg(F.count("*").alias("rows"))


@dataclass(frozen=True)
class Compaction:
    """What a run did: files before and after, and where the table's rows are now."""

    source: str
    target: str | None
    target_bytes: int
    files_before: int
    files_rewritten: int
    files_after: int


def partition_columns(spark: SparkSession, folder: str) -> list[str]:
    """The columns that a folder has from its paths, outermost first: those that its files lack."""
    in_files = spark.read.option("recursiveFileLookup", "true").parquet(folder).columns
    return [c for c in spark.read.parquet(folder).columns if c not in in_files]


def bins(files: DataFrame, target_bytes: int, files_per_share: int = FILES_PER_SHARE) -> DataFrame:
    """Path and bin of each file: files of one folder, the smallest first, up to the target size together.

    A folder of many files is cut into shares by the hash of the path, and bins are
    filled within a share, so no task holds more than a share of a folder's list.
    """
    placed = files.select("path", "length", F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
    counted = placed.groupBy("folder").agg(F.count("*").alias("files"))
    share = F.pmod(F.xxhash64("path"), F.ceil(F.col("files") / files_per_share))
    so_far = F.sum("length").over(Window.partitionBy("folder", "share").orderBy("length", "path")) - F.col("length")
    dealt = placed.join(counted, "folder").withColumn("share", share)
    return dealt.select("path", F.xxhash64("folder", "share", F.floor(so_far / target_bytes)).alias("bin"))


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    target_bytes: int = TARGET_BYTES,
    min_files: int = NIGHTLY_MIN_FILES,
) -> Compaction:
    """Rewrite a parquet folder's small files into files near the target size, in a new folder.

    Files of three quarters of the target or more are left alone, and so is everything
    where fewer than `min_files` are smaller. The small files of a partition are put
    together in bins of the target size, and each bin is written by one task, under the
    partition columns of the source. Readers of the old folder are not disturbed: the
    table is now what `compacted` reads, and removing the small files is the caller's step.
    The sizes are compared where the files are listed; only sums come to the driver.
    """
    small = F.col("length") < target_bytes * 3 // 4
    files = listing(spark, source)
    counts = files.agg(F.count("*").alias("all"), F.count_if(small).alias("small"), F.sum(F.when(small, F.col("length"))).alias("bytes")).first()
    if counts["small"] < min_files:
        return Compaction(source, None, target_bytes, counts["all"], 0, counts["all"])
    names = partition_columns(spark, source)
    rows = spark.read.parquet(source).where(F.col("_metadata.file_size") < target_bytes * 3 // 4)
    rows = rows.withColumn("path", F.col("_metadata.file_path")).join(bins(files.where(small), target_bytes), "path").drop("path")
    tasks = max(1, math.ceil(counts["bytes"] / target_bytes))
    # a bin is a little over the target at most; where two share a task, the writer parts them
    each = math.ceil(1.3 * rows.count() * target_bytes / max(1, counts["bytes"]))
    packed = rows.repartition(tasks, *names, "bin").drop("bin").write.option("maxRecordsPerFile", each)
    (packed.partitionBy(*names) if names else packed).parquet(target)
    written = listing(spark, target).count()
    return Compaction(source, target, target_bytes, counts["all"], counts["small"], counts["all"] - counts["small"] + written)


def compacted(spark: SparkSession, done: Compaction) -> DataFrame:
    """The table after a run: the source's files that stayed, and the new ones."""
    rows = spark.read.parquet(done.source)
    if done.target is None:
        return rows
    kept = rows.where(F.col("_metadata.file_size") >= done.target_bytes * 3 // 4)
    return kept.unionByName(spark.read.parquet(done.target))


def compact_on_demand(spark: SparkSession, source: str, target: str, target_size_mb: int = 128) -> Compaction:
    return compact(spark, source, target, target_size_mb * MEGABYTE, ON_DEMAND_MIN_FILES)


def orphan_files(spark: SparkSession, folder: str, live: DataFrame, older_than: datetime) -> DataFrame:
    """Parquet files in a folder that no live row comes from. Reports, never deletes.

    `live` is a frame over the live files.
    """
    used = file_statistics(live).select(F.col("file_path").alias("path"))
    aged = listing(spark, folder).where(F.col("modificationTime") < F.lit(older_than).cast("timestamp"))
    return aged.join(used, on="path", how="left_anti")
