"""Medallion queries: bronze, silver and gold over the order-event log."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom.catalogue import fixture
from orderloom.catalogue.fixture import BRONZE_SQL, DIMS_CTE, LIFECYCLE_SQL, SILVER_SQL
from orderloom.catalogue.registry import doubles, mean_of_cents, query, sum_of_cents, table
from orderloom.operators.rows import top
from orderloom.plans import gold, sales, silver
from orderloom.plans.daily import DailyMedallion
from orderloom.plans.medallion import Medallion
from orderloom.schemas import EVENT_TYPES
from orderloom.session import work_area
from orderloom.sources.files import event_log

MONEY = "decimal(12,2)"


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.enrich(fixture.bronze(spark, sf_dir), fixture.locations(spark, sf_dir), MONEY)


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.lifecycle(enriched(spark, sf_dir))


BRONZE_COLUMNS = (
    "event_id, event_type, ts, ts_seconds, location_id, order_id, sequence, body, event_timestamp"
)


@query("S3 F1 F15", f"{BRONZE_SQL} SELECT {BRONZE_COLUMNS} FROM bronze")
def bronze_orders(spark, sf_dir):
    """The log read from its files."""
    return event_log(spark, fixture.stored_log(spark, sf_dir))


@query(
    "S4 F3",
    f"""{BRONZE_SQL} SELECT event_id, event_type, CASE WHEN ts_seconds % 89 = 0 THEN 'at ' || ts ELSE ts END AS ts,
          CASE WHEN ts_seconds % 89 <> 0 THEN event_timestamp END AS event_timestamp FROM bronze""",
)
def bronze_tolerant(spark, sf_dir):
    """The same with unreadable times, which become NULL."""
    log = event_log(spark, fixture.stored_log(spark, sf_dir, broken_times=True), tolerant=True)
    return log.select("event_id", "event_type", "ts", "event_timestamp")


@query("S1", f"WITH {DIMS_CTE} SELECT * FROM items")
def dim_items(spark, sf_dir):
    return fixture.items(spark, sf_dir)


@query("S1", f"WITH {DIMS_CTE} SELECT * FROM categories")
def dim_categories(spark, sf_dir):
    return fixture.categories(spark, sf_dir)


@query("S1", f"WITH {DIMS_CTE} SELECT * FROM brands")
def dim_brands(spark, sf_dir):
    return fixture.brands(spark, sf_dir)


@query(
    "A6 J1 F5 F6 F11 P4 P5 P6 P11 P16 P17",
    f"""{SILVER_SQL}
    SELECT {BRONZE_COLUMNS}, brand_id, order_total, latitude, CAST(NULL AS DOUBLE) AS longitude, driver_id,
      event_hour, event_day_of_week, is_weekend, event_date, city_name
    FROM enriched""",
)
def orders_enriched(spark, sf_dir):
    """With the order total as the double it is stored as; the log's `lon` is no field of silver's."""
    return silver.enrich(fixture.bronze(spark, sf_dir), fixture.locations(spark, sf_dir))


@query("A5 A4 F7 P5 P12", f"{LIFECYCLE_SQL} SELECT * FROM lifecycle")
def order_lifecycle(spark, sf_dir):
    return lifecycle(spark, sf_dir)


@query("A4", f"{LIFECYCLE_SQL} SELECT * FROM milestones")
def order_milestones(spark, sf_dir):
    """All orders, delivered or not, through pivot()."""
    return silver.milestones_by_pivot(enriched(spark, sf_dir))


HOURLY_SQL = f"""
    SELECT event_date, event_hour, location_id, city_name,
      count(order_id) AS order_count,
      {sum_of_cents("order_total")} AS total_revenue,
      {mean_of_cents("order_total")} AS avg_order_value,
      count(DISTINCT brand_id) AS unique_brands
    FROM enriched WHERE event_type = 'order_created' GROUP BY ALL"""


@query("A1", SILVER_SQL + HOURLY_SQL)
def hourly_metrics(spark, sf_dir):
    hourly = gold.hourly_metrics(enriched(spark, sf_dir))
    return doubles(hourly, "total_revenue", "avg_order_value")


DELIVERY_SQL = """
    SELECT CAST(created_at AS DATE) AS order_date, location_id, city_name,
      count(order_id) AS completed_orders,
      avg(kitchen_duration_min) AS avg_kitchen_time_min,
      avg(delivery_duration_min) AS avg_delivery_time_min,
      avg(total_duration_min) AS avg_total_time_min,
      quantile_disc(total_duration_min, 0.5) AS median_total_time_min,
      quantile_disc(total_duration_min, 0.95) AS p95_total_time_min
    FROM lifecycle GROUP BY ALL"""


@query(
    "A2",
    f"""{LIFECYCLE_SQL} SELECT * REPLACE (round(avg_kitchen_time_min, 6) AS avg_kitchen_time_min,
      round(avg_delivery_time_min, 6) AS avg_delivery_time_min,
      round(avg_total_time_min, 6) AS avg_total_time_min) FROM ({DELIVERY_SQL})""",
)
def delivery_performance(spark, sf_dir):
    daily = gold.delivery_performance(lifecycle(spark, sf_dir))
    means = [c for c in daily.columns if c.startswith("avg_")]
    return daily.withColumns({c: F.round(c, 6) for c in means})


BRAND_SQL = f"""
    SELECT t.brand_id, b.name AS brand_name, t.* EXCLUDE (brand_id)
    FROM (SELECT brand_id, count(order_id) AS total_orders,
        {sum_of_cents("order_total")} AS total_revenue,
        {mean_of_cents("order_total")} AS avg_order_value,
        count(DISTINCT location_id) AS locations_served,
        min(event_date) AS first_order_date, max(event_date) AS last_order_date
      FROM enriched WHERE event_type = 'order_created' GROUP BY brand_id) t
    LEFT JOIN brands b ON b.id = t.brand_id"""


@query("A3 J2", SILVER_SQL + BRAND_SQL)
def brand_summary(spark, sf_dir):
    summary = gold.brand_summary(enriched(spark, sf_dir), fixture.brands(spark, sf_dir))
    return doubles(summary, "total_revenue", "avg_order_value")


@query(
    "O2 F17 P1",
    f"""{SILVER_SQL} SELECT brand_name, total_orders, round(total_revenue, 2) AS total_revenue,
      round(avg_order_value, 2) AS avg_order_value
    FROM ({BRAND_SQL}) ORDER BY total_revenue DESC, brand_name LIMIT 10""",
)
def top_brands(spark, sf_dir):
    summary = gold.brand_summary(enriched(spark, sf_dir), fixture.brands(spark, sf_dir))
    shown = summary.select(
        "brand_name",
        "total_orders",
        F.round("total_revenue", 2).alias("total_revenue"),
        F.round("avg_order_value", 2).alias("avg_order_value"),
    )
    return doubles(top(shown, 10, "total_revenue", "brand_name"), "total_revenue", "avg_order_value")


@query(
    "O6",
    f"""{SILVER_SQL} SELECT * FROM ({HOURLY_SQL})
    ORDER BY order_count DESC, event_date, event_hour, location_id NULLS FIRST LIMIT 5""",
)
def busiest_hours(spark, sf_dir):
    hourly = gold.hourly_metrics(enriched(spark, sf_dir))
    busiest = hourly.orderBy(F.desc("order_count"), "event_date", "event_hour", "location_id").limit(5)
    return doubles(busiest, "total_revenue", "avg_order_value")


@query(
    "A17 O4",
    f"""{LIFECYCLE_SQL} SELECT city_name, CAST(sum(completed_orders) AS BIGINT) AS total_orders,
      CAST(round(CAST(avg(avg_total_time_min) AS DECIMAL(18,6)), 1) AS DOUBLE) AS avg_time_min,
      CAST(round(CAST(avg(p95_total_time_min) AS DECIMAL(18,6)), 1) AS DOUBLE) AS p95_time_min
    FROM ({DELIVERY_SQL}) GROUP BY city_name""",
)
def delivery_by_city(spark, sf_dir):
    daily = gold.delivery_performance(lifecycle(spark, sf_dir))
    return gold.performance_by_city(daily).orderBy(F.desc("total_orders"))


@query(
    "A7 J3 F13",
    f"""{SILVER_SQL} SELECT t.brand_id, b.name AS brand_name, t.total_orders FROM (
      SELECT CASE WHEN json_valid(body) THEN CAST(json_extract_string(body, '$.brand_id') AS INTEGER) END
        AS brand_id, count(order_id) AS total_orders
      FROM bronze WHERE event_type = 'order_created' GROUP BY 1) t
    JOIN brands b ON b.id = t.brand_id""",
)
def brand_orders_by_path(spark, sf_dir):
    return gold.brand_orders_by_path(fixture.bronze(spark, sf_dir), fixture.brands(spark, sf_dir))


@query(
    "A11 O1",
    f"{BRONZE_SQL} SELECT event_type, count(*) AS count FROM bronze GROUP BY event_type",
)
def event_type_distribution(spark, sf_dir):
    return sales.distribution(fixture.event_log(spark, sf_dir), "event_type")


@query(
    "A20",
    f"""{SILVER_SQL} SELECT event_date, location_id, count(order_id) AS order_count,
      {sum_of_cents("order_total")} AS revenue
    FROM enriched GROUP BY event_date, location_id""",
)
def location_days(spark, sf_dir):
    daily = sales.location_days(
        enriched(spark, sf_dir), "event_date", "location_id", "order_id", "order_total"
    )
    return doubles(daily, "revenue")


@query(
    "G4 K1 K13 S6",
    f"""{LIFECYCLE_SQL}
    SELECT 'bronze.dim_brands' AS table_name, count(*) AS row_count FROM brands
    UNION ALL SELECT 'bronze.dim_categories', count(*) FROM categories
    UNION ALL SELECT 'bronze.dim_items', count(*) FROM items
    UNION ALL SELECT 'bronze.dim_locations', count(*) FROM locations
    UNION ALL SELECT 'bronze.orders', count(*) FROM bronze
    UNION ALL SELECT 'silver.orders_enriched', count(*) FROM enriched
    UNION ALL SELECT 'silver.order_lifecycle', count(*) FROM lifecycle
    UNION ALL SELECT 'gold.hourly_metrics', count(*) FROM ({HOURLY_SQL})
    UNION ALL SELECT 'gold.delivery_performance', count(*) FROM ({DELIVERY_SQL})
    UNION ALL SELECT 'gold.brand_summary', count(*) FROM ({BRAND_SQL})""",
)
def medallion_build(spark, sf_dir):
    """All ten tables written, then counted where they are stored."""
    target = work_area(spark, "medallion")
    build = Medallion(spark, f"loom_{uuid.uuid4().hex[:12]}", target, MONEY)
    return build.run(fixture.sources(spark, sf_dir))


@query(
    "A2 A17",
    f"""{LIFECYCLE_SQL}, ranked AS (SELECT city_name, count(*) AS orders FROM lifecycle GROUP BY city_name)
    SELECT city_name, orders, true AS median_close, true AS p95_close FROM ranked""",
)
def durations_by_city(spark, sf_dir):
    """Percentiles of a city's orders from stored daily sketches, and whether the exact ones are within half a percent of the orders."""
    folder, finished = work_area(spark, "sketches"), lifecycle(spark, sf_dir)
    sketches = gold.duration_sketches(finished)
    sketches.write.parquet(folder)
    found = gold.durations_by_city(spark.read.schema(sketches.schema).parquet(folder))
    renamed = found.withColumnRenamed("city_name", "city")
    spread = finished.join(renamed, F.col("city_name").eqNullSafe(F.col("city"))).groupBy("city_name")
    shares = {}
    for name, asked in (("median", 0.5), ("p95", 0.95)):
        answer, value = F.col(f"{name}_time_min"), F.col("total_duration_min")
        below, upto = F.avg((value < answer).cast("int")), F.avg((value <= answer).cast("int"))
        shares[f"{name}_close"] = (below - 0.005 <= asked) & (asked <= upto + 0.005)
    return spread.agg(F.first("orders").alias("orders"), *(c.alias(n) for n, c in shares.items()))


STEPS_SQL = "[" + ", ".join(f"'{t}'" for t in EVENT_TYPES) + "]"


def _daily_log(spark, sf_dir):
    """The given events as a log of a month: eight in a row are one order, whose events lie days apart."""
    step = (F.col("event_id") % 8).cast("int")
    moment = F.date_trunc("second", "ts").cast("timestamp")
    order = F.floor(F.col("event_id") / 8)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.element_at(F.lit(list(EVENT_TYPES)), step + 1).alias("event_type"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
        F.unix_timestamp(moment).alias("ts_seconds"),
        (order % 4 + 1).cast("int").alias("location_id"),
        F.concat(F.lit("O"), order.cast("string")).alias("order_id"),
        step.alias("sequence"),
        F.lit("{}").alias("body"),
        moment.alias("event_timestamp"),
    )


@query(
    "K1 D5 G4",
    f"""WITH log AS (SELECT event_id, date_trunc('second', ts) AS t, event_id // 8 AS o, CAST(event_id % 8 AS INTEGER) AS step FROM events),
    lifecycle AS (SELECT o, min(t) FILTER (step = 0) AS created_at, min(t) FILTER (step = 7) AS delivered_at FROM log
                  GROUP BY o HAVING delivered_at IS NOT NULL),
    hours AS (SELECT count(*) AS n FROM log WHERE step = 0 GROUP BY CAST(t AS DATE), hour(t), o % 4)
    SELECT (SELECT count(*) FROM log WHERE event_id % 3 = 0 AND CAST(t AS DATE) = (SELECT CAST(min(ts) AS DATE) + 10 FROM events)) AS late_events,
      (SELECT count(*) FROM log) AS silver_rows, count(*) AS delivered,
      CAST(sum(epoch(delivered_at) - epoch(created_at)) AS BIGINT) AS seconds,
      count(DISTINCT (CAST(created_at AS DATE), o % 4)) AS performance_rows,
      (SELECT count(*) FROM hours) AS hours, (SELECT CAST(sum(n) AS BIGINT) FROM hours) AS orders, CAST(1 AS BIGINT) AS silver_days_written
    FROM lifecycle""",
)
def rebuilt_day(spark, sf_dir):
    """A medallion by day, built before the last events of a day came, then that day built anew."""
    log = _daily_log(spark, sf_dir)
    sources = replace(fixture.sources(spark, sf_dir), events=log)
    day = log.agg(F.min(F.to_date("event_timestamp"))).first()[0] + timedelta(days=10)
    late = (F.to_date("event_timestamp") == F.lit(day)) & (F.col("event_id").cast("long") % 3 == 0)
    built = DailyMedallion(spark, f"loom_{uuid.uuid4().hex[:10]}", work_area(spark, "daily"))
    built.run(replace(sources, events=log.where(~late)))
    arrived = Observation()
    log.where(late).observe(arrived, F.count(F.lit(1)).alias("rows")).write.insertInto(built.name("bronze", "orders"))
    wrote = built.rebuild([day])
    finished, hourly = built.read("silver", "order_lifecycle"), built.read("gold", "hourly_metrics")
    taken = F.sum(F.unix_timestamp("delivered_at") - F.unix_timestamp("created_at"))
    return finished.agg(F.count("*").alias("delivered"), taken.alias("seconds")).select(
        F.lit(arrived.get["rows"]).cast("long").alias("late_events"),
        built.read("silver", "orders_enriched").agg(F.count("*")).scalar().alias("silver_rows"),
        "delivered",
        "seconds",
        built.read("gold", "delivery_performance").agg(F.count("*")).scalar().alias("performance_rows"),
        hourly.agg(F.count("*")).scalar().alias("hours"),
        hourly.agg(F.sum("order_count")).scalar().alias("orders"),
        F.lit(len(wrote["orders_enriched"])).cast("long").alias("silver_days_written"),
    )
