"""Synthetic rows over a rate stream, or over any frame with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rate_stream(spark: SparkSession, rows_per_second: int = 5) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def click_events(ticks: DataFrame) -> DataFrame:
    """(timestamp, value) ticks as click and view events of ten users."""
    value = F.col("value")
    return ticks.select(
        value.alias("event_id"),
        F.when(value % 2 == 0, "click").otherwise("view").alias("event_type"),
        (value % 10 + 1).alias("user_id"),
        (value * 10).alias("event_value"),
        "timestamp",
    )


def sale_events(ticks: DataFrame) -> DataFrame:
    """Ticks as placed orders; the event id is random, the rest follows `value`.

    Fixed values: prefixes, product and price.
    """
    value = F.col("value")
    priced = ticks.select(
        F.expr("uuid()").alias("event_id"),
        F.lit("order_placed").alias("event_type"),
        F.col("timestamp").alias("event_timestamp"),
        F.concat(F.lit("RATE-"), value.cast("string")).alias("order_id"),
        F.concat(F.lit("CUST-"), (value % 10 + 100).cast("string")).alias("customer_id"),
        F.lit("PROD-001").alias("product_id"),
        F.lit("Test Product").alias("product_name"),
        (value % 3 + 1).cast("int").alias("quantity"),
        F.lit(99.99).alias("unit_price"),
        F.current_timestamp().alias("processing_time"),
    )
    return priced.withColumn("total", F.col("unit_price") * F.col("quantity"))
