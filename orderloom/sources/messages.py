"""Message logs: key, value, timestamp.

A job takes its reader as an argument, so the same code runs on a Kafka topic
and on a parquet folder holding the same three columns. Positions in a folder are
message times: its files are written in the order of time, so that a reader of a range
skips the files and row groups outside of it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.functions.payload import as_message
from orderloom.operators.rows import since_day

# The fields of a replayed event, in the order its JSON has them.
EVENT_MESSAGE = [
    "event_id", "event_type", "ts", "ts_seconds", "location_id", "order_id", "sequence", "body",
]

MESSAGE_FIELDS = "key binary, value binary, timestamp timestamp"


def topic_options(
    servers: str,
    topic: str,
    start: str = "latest",
    end: str | None = None,
    fail_on_data_loss: bool | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if end is not None:
        options["endingOffsets"] = end
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    return options


def topic_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **options)).load()


def topic_batch(
    spark: SparkSession, servers: str, topic: str, start: str = "earliest", end: str = "latest"
) -> DataFrame:
    return spark.read.format("kafka").options(**topic_options(servers, topic, start, end)).load()


def append_messages(
    rows: DataFrame, path: str, moment: str = "timestamp", message: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Put messages into a topic's folder, in the order of their time within and between the files.

    The other columns, which come next in the order, let a crowded moment span several files.
    A range shuffle goes over its input twice, first for the cuts, so rows are dealt while they are
    narrow: `message` makes messages of them where they have come to lie, in the order they lie in.
    """
    ranged = rows.repartitionByRange(moment, F.xxhash64(*(c for c in rows.columns if c != moment)))
    sent = ranged.sortWithinPartitions(moment)
    (message(sent) if message else sent).write.mode("append").parquet(path)


def between(messages: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Messages from a position on and before another one; None is the earliest, or the latest.

    For batches and streams. Both bounds reach the scan. A stream that is started again must
    be given the start that it was first given: what arrived in between counts.
    """
    moment = F.col("timestamp")
    if start is not None:
        messages = messages.where(moment >= F.lit(start))
    return messages if end is None else messages.where(moment < F.lit(end))


def folder_batch(spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """A topic's folder between two positions."""
    return between(spark.read.schema(MESSAGE_FIELDS).parquet(path), start, end)


def latest_position(spark: SparkSession, path: str) -> datetime | None:
    """The time just after the newest message: where a reader begins that wants only what comes now.

    Reads the times only. None for an empty folder.
    """
    newest = spark.read.schema(MESSAGE_FIELDS).parquet(path).agg(F.max("timestamp"))
    return newest.select(F.timestamp_add("MICROSECOND", F.lit(1), F.col(newest.columns[0]))).first()[0]


def folder_stream(
    spark: SparkSession,
    path: str,
    schema: str | StructType = MESSAGE_FIELDS,
    files_per_batch: int | None = None,
) -> DataFrame:
    """A parquet file, or a folder of them, as a stream.

    The source takes a single file only as the match of a pattern, so the path is made
    one that matches itself and nothing else. A file that was seen and is gone by the time
    its batch comes is passed over, as a topic is read without `failOnDataLoss`.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]")


def as_text(messages: DataFrame) -> DataFrame:
    """Key and value as strings."""
    return messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def value_text() -> Column:
    return F.col("value").cast("string")


def replay(events: DataFrame, start_day: int = 0) -> DataFrame:
    """The log from a day on as messages keyed by order, each order's in the order they happened.

    A topic keeps the order of a key, so the log is dealt by order and sorted where it
    lies, not as a whole. Events that have lost their order follow none and are dealt by themselves.
    """
    recent = since_day(events, start_day).repartition(F.coalesce("order_id", "event_id"))
    sent = recent.sortWithinPartitions("ts_seconds", "sequence", "event_id")
    return as_message(sent, F.col("order_id"), EVENT_MESSAGE)
