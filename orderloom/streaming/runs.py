"""Starting, bounding and watching streaming queries.

Sinks write to tables or folders; the checkpoint makes a restart go on where the
last run ended, so a file sink holds every row once.
"""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType


def _writer(
    stream: DataFrame, checkpoint: str, interval: str | None, partition_by: list[str] | None
) -> DataStreamWriter:
    """Append writer; without an interval it takes what is there and ends."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.partitionBy(*partition_by) if partition_by else writer


def append_to_table(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    interval: str | None = None,
    partition_by: list[str] | None = None,
    **options: str,
) -> StreamingQuery:
    """Append to a catalog table, created on the first run."""
    return _writer(stream, checkpoint, interval, partition_by).options(**options).toTable(table)


def append_to_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    return _writer(stream, checkpoint, interval, partition_by).format("parquet").start(path)


def update_files(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Changed rows of an aggregate, a folder per batch.

    A batch that is run again after a failure replaces its own folder.
    """

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def last_values(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """What `update_files` has written: the newest row of every key."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(path)
    rest = [f.name for f in schema.fields if f.name not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch")).alias("last"))
    return newest.select(*keys, "last.*")


def to_console(stream: DataFrame, mode: str = "append", rows: int = 20) -> StreamingQuery:
    """Print each batch: `update` for aggregates, `append` for plain rows."""
    writer = stream.writeStream.outputMode(mode).format("console")
    return writer.option("truncate", False).option("numRows", rows).start()


def finish(query: StreamingQuery, seconds: float | None = None, every: float = 0.5) -> list[dict]:
    """Wait for the query to end, or stop it after the given time.

    Returns the progress reports of all its batches, gathered while it runs: a query
    itself keeps only the last ones. An error of the query is raised here.
    """
    deadline = None if seconds is None else time.monotonic() + seconds
    reports: dict[int, dict] = {}  # by batch
    while True:
        ended = query.awaitTermination(every)
        reports |= {p["batch"]: p for p in progress(query)}
        if ended:
            break
        if deadline is not None and time.monotonic() >= deadline:
            query.stop()
            break
    reports |= {p["batch"]: p for p in progress(query)}
    return [reports[b] for b in sorted(reports)]


def progress(query: StreamingQuery) -> list[dict]:
    """The reports that the query still keeps: batch, rows read, time, watermark, state, and what `measured` asked for."""
    return [
        {
            "batch": p["batchId"],
            "rows": p["numInputRows"],
            "at": p["timestamp"],
            "watermark": (p.get("eventTime") or {}).get("watermark"),
            "state_rows": sum(s["numRowsTotal"] for s in p["stateOperators"]),
            "state_removed": sum(s["numRowsRemoved"] for s in p["stateOperators"]),
            "late_rows": sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]),
            "measures": {k: v for row in (p.get("observedMetrics") or {}).values() for k, v in row.asDict().items()},
        }
        for p in query.recentProgress
    ]


def measured(stream: DataFrame, name: str, **measures: Column) -> DataFrame:
    """A stream whose progress reports carry these aggregates of each batch: computed as the rows go by, by no job of their own."""
    return stream.observe(name, *(c.alias(k) for k, c in measures.items()))


def append_progress(spark: SparkSession, reports: Iterable[dict], measures: str, path: str) -> None:
    """Add the reports of a run to a table of progress, the measures as columns of the given types.

    A few numbers per batch, all that a query gives its driver.
    """
    head = "batch long, rows long, at string, watermark string, state_rows long, state_removed long, late_rows long"
    schema = StructType.fromDDL(f"{head}, {measures}")
    flat = [r | r["measures"] for r in reports]
    rows = [tuple(r.get(f.name) for f in schema.fields) for r in flat]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def drain(query: StreamingQuery) -> list[dict]:
    """Let a query with an interval take all that has arrived, stop it between batches, and return its reports."""
    query.processAllAvailable()
    query.stop()
    return progress(query)


def open_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What a stateful query keeps after its last batch, a row per key: key and value as structs."""
    return spark.read.format("statestore").load(checkpoint).select("key", "value")


def watch(query: StreamingQuery, seconds: float, every: float = 1.0) -> list[dict]:
    """Follow a running query for a while, then stop it."""
    return finish(query, seconds, every)


def table_stream(spark: SparkSession, table: str) -> DataFrame:
    """Follow a table that a stream appends to."""
    return spark.readStream.table(table)
