"""Batch readers over files and catalog tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.times import iso_timestamp, tolerant_timestamp


def dimension(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """A dimension file, registered as a view when a name is given."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def with_event_time(events: DataFrame, tolerant: bool = False) -> DataFrame:
    """The event log with `event_timestamp` parsed from its `ts` text."""
    parse = tolerant_timestamp if tolerant else iso_timestamp
    return events.withColumn("event_timestamp", parse(F.col("ts")))


def event_log(spark: SparkSession, path: str, tolerant: bool = False) -> DataFrame:
    return with_event_time(spark.read.parquet(path), tolerant)


def first_existing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first path that exists: a one-day sample, else the full history."""
    for path in paths[:-1]:
        try:
            return spark.read.parquet(path)
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.read.parquet(paths[-1])


def json_directory(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; give the schema to spare the inference pass over all files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)
