"""Silver: enriched events and one row per delivered order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.payload import parse_named
from orderloom.functions.times import calendar_features, minutes_between
from orderloom.operators.joins import lookup
from orderloom.operators.rows import present
from orderloom.schemas import BODY_COLUMNS, DURATIONS, MILESTONES, body_fields

# The event columns that silver keeps.
EVENT_COLUMNS = [
    "event_id", "event_type", "event_timestamp", "ts", "ts_seconds",
    "order_id", "location_id", "sequence", "body",
]


def city_names(locations: DataFrame) -> DataFrame:
    return locations.selectExpr("id AS location_id", "city AS city_name")


def enrich(events: DataFrame, locations: DataFrame, money: str = "double") -> DataFrame:
    """Usable events with body fields, calendar features and city.

    Events without id, order or time are dropped. A malformed body gives NULL
    fields, an unknown or NULL location a NULL city. Copies are kept.
    """
    usable = present(events, "event_id", "order_id", "event_timestamp")
    payload = parse_named(F.col("body"), body_fields(money))
    parsed = usable.select(*EVENT_COLUMNS, payload.alias("payload"))
    featured = parsed.select(
        *EVENT_COLUMNS,
        *(F.col(f"payload.{key}").alias(name) for key, name in BODY_COLUMNS.items()),
        *(c.alias(name) for name, c in calendar_features(F.col("event_timestamp")).items()),
    )
    return lookup(featured, city_names(locations), on="location_id")


def milestones(enriched: DataFrame) -> DataFrame:
    """One row per order and location: the first time of each milestone.

    One conditional minimum per milestone: a single shuffle on the order with
    map-side combine, where pivot() would aggregate and shuffle twice.
    """
    first = [
        F.min(F.when(F.col("event_type") == kind, F.col("event_timestamp"))).alias(name)
        for name, kind in MILESTONES.items()
    ]
    return enriched.groupBy("order_id", "location_id", "city_name").agg(*first)


def milestones_by_pivot(enriched: DataFrame) -> DataFrame:
    """The same table through pivot(); the values are given, so no extra job finds them."""
    wide = (
        enriched.groupBy("order_id", "location_id", "city_name")
        .pivot("event_type", list(MILESTONES.values()))
        .agg(F.min("event_timestamp"))
    )
    return wide.withColumnsRenamed({kind: name for name, kind in MILESTONES.items()})


def lifecycle(enriched: DataFrame) -> DataFrame:
    """Delivered orders with their milestones and durations in minutes."""
    delivered = milestones(enriched).where(F.col("delivered_at").isNotNull())
    return delivered.withColumns(
        {
            name: minutes_between(F.col(later), F.col(earlier))
            for name, (later, earlier) in DURATIONS.items()
        }
    )
