"""Tumbling windows over event time.

Counts and sums combine before the shuffle, so a hot key sends one partial row
per task and window. A watermark bounds the state: closed windows are given out in
append mode and leave it; without one it grows for as long as the query runs. Window sizes and patience of the four jobs are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling(
    events: DataFrame, moment: str, size: str, key: str, *measures: Column, late: str | None = None
) -> DataFrame:
    """Measures per window and key, the window as two columns.

    `late` is how far behind the newest event a row may come and still count.
    """
    if late:
        events = events.withWatermark(moment, late)
    windows = events.groupBy(F.window(moment, size), key).agg(*measures)
    return windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *(c for c in windows.columns if c != "window"),
    )


def type_totals(events: DataFrame, late: str | None = None) -> DataFrame:
    """Count and value per type every ten seconds."""
    return tumbling(
        events, "timestamp", "10 seconds", "event_type",
        F.count("*").alias("count"), F.sum("event_value").alias("total_value"), late=late,
    )


def product_revenue(clicks: DataFrame, late: str | None = None) -> DataFrame:
    """Count and revenue per product every thirty seconds."""
    return tumbling(
        clicks, "event_timestamp", "30 seconds", "product",
        F.count("*").alias("event_count"), F.sum("revenue").alias("total_revenue"), late=late,
    )


def type_counts(events: DataFrame, moment: str = "ts", late: str | None = "10 minutes") -> DataFrame:
    """Count per type every five minutes, ten minutes of patience."""
    return tumbling(events, moment, "5 minutes", "event_type", F.count("*").alias("count"), late=late)


def category_counts(events: DataFrame, moment: str = "event_time", late: str | None = "1 hour") -> DataFrame:
    """Count per category every ten minutes, one hour of patience."""
    return tumbling(events, moment, "10 minutes", "category", F.count("*").alias("count"), late=late)
