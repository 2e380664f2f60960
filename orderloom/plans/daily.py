"""The medallion by day: a rebuild of some days writes these days only.

Silver's events lie by their date, the delivered orders by the date of delivery, the hourly
and the delivery metrics by their day. What a day's events change is found by the orders
they belong to, so an order that crosses midnight is right on both sides of it.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.plans import gold, silver
from orderloom.plans.medallion import Medallion
from orderloom.session import work_area

# The column that each of these tables lies by; the others are one piece.
DAYS = {
    "orders_enriched": "event_date",
    "order_lifecycle": "delivered_date",
    "hourly_metrics": "event_date",
    "delivery_performance": "order_date",
}


def on(days: list[date | None], column: Column | str) -> Column:
    """Rows of these days, NULL being a day like others; a condition that chooses partitions."""
    column = F.col(column) if isinstance(column, str) else column
    known = [F.lit(d) for d in days if d is not None]
    chosen = column.isin(*known) if known else F.lit(False)
    return chosen | column.isNull() if None in days else chosen


def delivered(enriched: DataFrame) -> DataFrame:
    """Silver's lifecycle and the date that it lies by."""
    return silver.lifecycle(enriched).withColumn("delivered_date", F.to_date("delivered_at"))


@dataclass(frozen=True)
class DailyMedallion(Medallion):
    """The same ten tables, four of them partitioned by a day."""

    def write(self, layer: str, table: str, df: DataFrame) -> None:
        if table == "order_lifecycle":
            df = df.withColumn("delivered_date", F.to_date("delivered_at"))
        if table in DAYS:
            df = df.hint("rebalance", DAYS[table])
        self.save(layer, table, df, [DAYS[table]] if table in DAYS else [])

    def stored(self, df: DataFrame, area: str, name: str) -> DataFrame:
        """An intermediate result: what follows overwrites what it was read from."""
        df.write.parquet(f"{area}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{area}/{name}")

    @contextmanager
    def swapping(self):
        """Inserts that overwrite replace the partitions they bring, and no others."""
        key = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "dynamic")
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def overwrite_days(self, layer: str, table: str, df: DataFrame, days: list[date | None]) -> list[date | None]:
        """Replace these days of a table by rows of them; a day without rows goes. Returns the days written.

        The partitions that the rows are of are swapped when all of them are written; the days
        that they are of are gathered as they pass, by no job of its own.
        """
        name, column = self.name(layer, table), DAYS[table]
        seen = Observation()
        moved = df.select(*self.spark.table(name).columns).hint("rebalance", column)
        moved = moved.observe(seen, F.collect_set(column).alias("days"), F.count_if(F.col(column).isNull()).alias("dateless"))
        with self.swapping():
            moved.write.mode("overwrite").insertInto(name)
        written = sorted(seen.get["days"]) + ([None] if seen.get["dateless"] else [])
        stale = {r[0] for r in self.spark.table(name).where(on(days, column)).select(column).distinct().collect()} - set(written)
        for day in stale:
            value = "NULL" if day is None else f"DATE'{day}'"
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column} = {value})")
        return written

    def rebuild(self, days: list[date], span: int | None = None) -> dict[str, list[date | None]]:
        """Build silver and gold anew where the given days of bronze bear on them; returns the days written per table.

        `span` is how many days an order's events may lie apart, where that is known: no
        other days of silver are read then. The brands' totals are over all days and are built as a whole.
        """
        area = work_area(self.spark, "rebuild")
        chosen = on(days, "event_date")
        before = self.read("silver", "orders_enriched").where(chosen).select("order_id").distinct()
        before = self.stored(before, area, "orders-before")
        bronze = self.read("bronze", "orders").where(on(days, F.to_date("event_timestamp")))
        fresh = silver.enrich(bronze, self.read("bronze", "dim_locations"), self.money)
        wrote = {"orders_enriched": self.overwrite_days("silver", "orders_enriched", fresh, days)}

        enriched = self.read("silver", "orders_enriched")
        today = enriched.where(chosen)
        touched = self.stored(before.unionByName(today.select("order_id")).distinct(), area, "orders")
        near = enriched
        if span is not None:
            near = near.where(F.col("event_date").between(F.date_sub(F.lit(min(days)), span), F.date_add(F.lit(max(days)), span)))
        lifecycle = self.read("silver", "order_lifecycle")
        old = self.stored(lifecycle.join(touched, "order_id", "left_semi"), area, "lifecycle-before")
        new = self.stored(delivered(near.join(touched, "order_id", "left_semi")), area, "lifecycle")
        both = old.select("delivered_date", "created_at").unionByName(new.select("delivered_date", "created_at"))
        ends = [r[0] for r in both.select("delivered_date").distinct().collect()]  # days, at most as many as silver has
        starts = [r[0] for r in both.select(F.to_date("created_at")).distinct().collect()]
        others = lifecycle.where(on(ends, "delivered_date")).join(touched, "order_id", "left_anti")
        others = self.stored(others, area, "lifecycle-others")
        wrote["order_lifecycle"] = self.overwrite_days("silver", "order_lifecycle", new.unionByName(others), ends)

        wrote["hourly_metrics"] = self.overwrite_days("gold", "hourly_metrics", gold.hourly_metrics(today), days)
        finished = self.read("silver", "order_lifecycle").where(on(starts, F.to_date("created_at")))
        performance = gold.delivery_performance(finished)
        wrote["delivery_performance"] = self.overwrite_days("gold", "delivery_performance", performance, starts)
        created = gold.created(enriched).select("event_type", *gold.SALES_INPUTS)
        self.write("gold", "brand_summary", gold.brand_summary(created, self.read("bronze", "dim_brands")))
        return wrote

