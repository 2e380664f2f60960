"""Message streams to typed columns; batch frames of messages work as well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.payload import may_hold, unpack
from orderloom.functions.times import MICROS, iso_timestamp, patterned_timestamp
from orderloom.schemas import CLICK_FIELDS, CREATED_FIELDS, EVENT_FIELDS, SALE_FIELDS
from orderloom.sources.messages import value_text


def order_events(messages: DataFrame) -> DataFrame:
    """The bronze event columns, the message time, and the parsed event time."""
    events = unpack(messages, value_text(), EVENT_FIELDS, F.col("timestamp").alias("kafka_timestamp"))
    return events.withColumn("event_timestamp", iso_timestamp(F.col("ts")))


def created_orders(messages: DataFrame) -> DataFrame:
    """The messages of new orders; those that cannot name the type are not parsed."""
    named = messages.where(may_hold(value_text(), "order_created"))
    return unpack(named, value_text(), CREATED_FIELDS).where("event_type = 'order_created'")


def clicks(messages: DataFrame) -> DataFrame:
    """Click messages with their time, which needs six fraction digits, and revenue."""
    parsed = unpack(messages, value_text(), CLICK_FIELDS)
    return parsed.withColumns(
        {
            "event_timestamp": patterned_timestamp(F.col("timestamp"), MICROS),
            "revenue": F.col("price") * F.col("quantity"),
        }
    )


def sales(messages: DataFrame) -> DataFrame:
    """Sale messages with event time and the time they were processed."""
    parsed = unpack(messages, value_text(), SALE_FIELDS)
    timed = parsed.withColumns(
        {
            "event_timestamp": F.to_timestamp("timestamp"),
            "processing_time": F.current_timestamp(),
        }
    )
    return timed.drop("timestamp")


def with_orders(events: DataFrame) -> DataFrame:
    """The next table down the chain: rows of an order, stamped."""
    return events.where(F.col("order_id").isNotNull()).withColumn("processed_at", F.current_timestamp())
