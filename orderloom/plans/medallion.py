"""The ten medallion tables, built in dependency order."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom.plans import gold, silver

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Sources:
    """What the medallion starts from; `events` carries `event_timestamp`."""

    events: DataFrame
    categories: DataFrame
    brands: DataFrame
    items: DataFrame
    locations: DataFrame


@dataclass(frozen=True)
class Medallion:
    """Tables live in one schema per layer: `<prefix>_bronze` and so on."""

    spark: SparkSession
    prefix: str
    location: str | None = None
    money: str = "double"
    written: dict[str, int] = field(default_factory=dict, compare=False)

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}_{layer}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def create_schemas(self) -> None:
        for layer in LAYERS:
            place = f" LOCATION '{self.location}/{layer}'" if self.location else ""
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.prefix}_{layer}{place}")

    def write(self, layer: str, table: str, df: DataFrame) -> None:
        """Full overwrite: a run replaces what the last one left."""
        self.save(layer, table, df, [])

    def save(self, layer: str, table: str, df: DataFrame, partition_by: list[str]) -> None:
        """Write a table and note its number of rows, counted as they are written."""
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(self.name(layer, table))
        self.written[f"{layer}.{table}"] = seen.get["rows"]

    def write_together(self, layer: str, frames: dict[str, DataFrame]) -> None:
        """Tables that do not read each other, as jobs side by side."""
        write = inheritable_thread_target(self.spark)(self.write)
        with ThreadPoolExecutor(len(frames)) as pool:
            for job in [pool.submit(write, layer, table, df) for table, df in frames.items()]:
                job.result()

    def build_bronze(self, sources: Sources) -> None:
        self.write_together(
            "bronze",
            {
                "dim_categories": sources.categories,
                "dim_brands": sources.brands,
                "dim_items": sources.items,
                "dim_locations": sources.locations,
                "orders": sources.events,
            },
        )

    def build_silver(self) -> None:
        events = self.read("bronze", "orders")
        places = self.read("bronze", "dim_locations")
        # sorted by type where they lie, so that a reader of one type skips most pages
        enriched = silver.enrich(events, places, self.money).sortWithinPartitions("event_type", "event_date")
        self.write("silver", "orders_enriched", enriched)
        self.write("silver", "order_lifecycle", silver.lifecycle(self.read("silver", "orders_enriched")))

    def build_gold(self) -> None:
        # a few columns of the rows of one type, which lie together: each table below reads them for itself
        created = gold.created(self.read("silver", "orders_enriched")).select("event_type", *gold.SALES_INPUTS)
        finished = self.read("silver", "order_lifecycle")
        brands = self.read("bronze", "dim_brands")
        self.write_together(
            "gold",
            {
                "hourly_metrics": gold.hourly_metrics(created),
                "delivery_performance": gold.delivery_performance(finished),
                "brand_summary": gold.brand_summary(created, brands),
            },
        )

    def run(self, sources: Sources, layer: str | None = None) -> DataFrame:
        """Build all layers, or one of them from its stored inputs; returns row counts."""
        self.create_schemas()
        if layer in (None, "bronze"):
            self.build_bronze(sources)
        if layer in (None, "silver"):
            self.build_silver()
        if layer in (None, "gold"):
            self.build_gold()
        return self.row_counts([layer] if layer else list(LAYERS))

    def row_counts(self, layers: list[str]) -> DataFrame:
        """What the writes of these layers have counted, a row per table: no table is read again."""
        return written_counts(self.spark, {name: n for name, n in self.written.items() if name.split(".")[0] in layers})


def written_counts(spark: SparkSession, written: dict[str, int]) -> DataFrame:
    """One (table_name, row_count) row per table, by name."""
    return spark.createDataFrame(sorted(written.items()), "table_name string, row_count long")


def validate(*plans: DataFrame) -> None:
    """Analysis only: a missing table or column raises before any job starts."""
    for plan in plans:
        plan.schema  # noqa: B018
