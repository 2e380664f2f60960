"""The medallion as declared datasets for Spark's declarative runner.

A definitions file for the runner calls `define_medallion` once. The functions
only build plans; the runner finds the order, writes the tables and validates
them without data in a dry run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import pipelines as dp
from pyspark.sql import DataFrame, SparkSession

from orderloom.plans import gold, silver
from orderloom.sources.files import event_log
from orderloom.streaming import bronze

DIMENSIONS = ("categories", "brands", "items", "locations")


def define_medallion(
    dimension_paths: dict[str, str],
    events_path: str,
    messages: Callable[[], DataFrame] | None = None,
    prefix: str = "",
    money: str = "double",
) -> None:
    """Declare all tables; `messages` adds the streaming bronze table.

    Schemas are `<prefix>bronze`, `<prefix>silver` and `<prefix>gold`.
    """

    def stored(name: str) -> DataFrame:
        return SparkSession.active().table(prefix + name)

    def declare(name: str, plan: Callable[[], DataFrame], comment: str) -> None:
        dp.materialized_view(plan, name=prefix + name, comment=comment)

    def dimension_plan(path: str) -> Callable[[], DataFrame]:
        return lambda: SparkSession.active().read.parquet(path)

    for name in DIMENSIONS:
        declare(f"bronze.dim_{name}", dimension_plan(dimension_paths[name]), f"Dimension {name}")
    declare(
        "bronze.orders",
        lambda: event_log(SparkSession.active(), events_path),
        "Order events with their time",
    )
    if messages is not None:
        dp.table(
            lambda: bronze.order_events(messages()),
            name=prefix + "bronze.orders_streaming",
            comment="Order events as they arrive",
        )
    declare(
        "silver.orders_enriched",
        lambda: silver.enrich(stored("bronze.orders"), stored("bronze.dim_locations"), money),
        "Usable events with body fields, calendar features and city",
    )
    declare(
        "silver.order_lifecycle",
        lambda: silver.lifecycle(stored("silver.orders_enriched")),
        "Delivered orders with milestones and durations",
    )
    created_view = prefix.replace(".", "_") + "created_orders"
    dp.temporary_view(
        lambda: gold.created(stored("silver.orders_enriched")),
        name=created_view,
        comment="What hourly and brand metrics are taken from",
    )

    def created() -> DataFrame:
        return SparkSession.active().table(created_view)

    declare("gold.hourly_metrics", lambda: gold.hourly_metrics(created()), "Orders per hour and location")
    declare(
        "gold.delivery_performance",
        lambda: gold.delivery_performance(stored("silver.order_lifecycle")),
        "Delivery times per day and location",
    )
    declare(
        "gold.brand_summary",
        lambda: gold.brand_summary(created(), stored("bronze.dim_brands")),
        "Orders and revenue per brand",
    )
