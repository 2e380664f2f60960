"""The order-event log as a deterministic view of the given `orders` table.

One order becomes up to eight lifecycle events, with the faults a real log has:
copies, NULL keys, malformed bodies, an event whose location is lost. The same
rules are written once for Spark and once as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.catalogue.registry import table
from orderloom.plans.medallion import Sources
from orderloom.schemas import EVENT_TYPES
from orderloom.session import work_area
from orderloom.sources.files import with_event_time

STEPS = list(EVENT_TYPES)

# What the log tells of an order.
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice"]


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events: the eight columns of the log, times as text."""
    return described(steps(spark, sf_dir))


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow row per event: its order, step and copy, and when it happened."""
    key, step, copy = F.col("o_orderkey"), F.col("sequence"), F.col("dup")
    last_step = F.when(F.col("o_orderstatus") == "F", 7).when(F.col("o_orderstatus") == "P", 6).otherwise(3)
    copies = F.when((key % 41 == 0) & (step == 0), F.array(F.lit(0), F.lit(1)))
    expanded = (
        table(spark, sf_dir, "orders")
        .select(*ORDER_COLUMNS, "o_orderdate", F.explode(F.sequence(F.lit(0), last_step)).alias("sequence"))
        .withColumn("dup", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
    )
    shift = key % 1440 * 60 + step * 600 + (key * 7 + step * 13) % 300 + copy * (key % 2) * 5
    moment = F.timestamp_add("SECOND", shift.cast("int"), F.col("o_orderdate").cast("timestamp"))
    return expanded.select(*ORDER_COLUMNS, "sequence", moment.alias("moment"))


def described(happened: DataFrame) -> DataFrame:
    """The steps as events of the log, in the order they lie in."""
    key, step = F.col("o_orderkey"), F.col("sequence")
    log = happened.withColumn("event_type", F.get(F.lit(STEPS), step))
    no_place = (key % 50 == 0) | ((key % 53 == 0) & (step == 1))
    total = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    brand = (key % 20 + 1).cast("string")
    driver = F.concat(F.lit('"driver_id": "D'), (key % 500).cast("string"), F.lit('"}'))
    place = F.concat(F.lit('{"lat": '), (key % 90).cast("string"), F.lit('.5, "lon": 7.25, '))
    body = (
        F.when((step == 1) & (key % 101 == 0), '{"kitchen_id": 1} x')
        .when((step == 2) & (key % 103 == 0), "")
        .when(F.col("event_type") == "driver_ping", F.concat(place, driver))
        .when(F.col("event_type") == "driver_arrived", F.concat(F.lit("{"), driver))
        .when(step != 0, "{}")
        .when(key % 97 == 0, '{"brand_id": 3, "tot')
        .otherwise(F.concat(F.lit('{"brand_id": '), brand, F.lit(', "total": '), total, F.lit("}")))
    )
    return log.select(
        F.concat_ws("-", key.cast("string"), step.cast("string")).alias("event_id"),
        "event_type",
        F.date_format("moment", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
        F.unix_timestamp("moment").alias("ts_seconds"),
        F.when(~no_place, F.col("o_custkey") % 4 + 1).cast("int").alias("location_id"),
        F.when(~((key % 71 == 0) & (step == 2)), F.concat(F.lit("O"), key.cast("string"))).alias("order_id"),
        "sequence",
        body.alias("body"),
    )


def stored_log(spark: SparkSession, sf_dir: str, broken_times: bool = False) -> str:
    """The log as files; where asked for, with times nobody can read."""
    log, folder = event_log(spark, sf_dir), work_area(spark, "event-log")
    if broken_times:
        unreadable = F.col("ts_seconds") % 89 == 0
        log = log.withColumn("ts", F.when(unreadable, F.concat(F.lit("at "), "ts")).otherwise(F.col("ts")))
    log.write.parquet(folder)
    return folder


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(event_log(spark, sf_dir))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr("r_regionkey AS id", "r_name AS city")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(f"{CATEGORY} AS id", "p_type AS name").distinct()


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(f"{BRAND} AS id", "p_brand AS name").distinct()


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id",
        f"{BRAND} AS brand_id",
        "p_name AS name",
        "p_retailprice AS price",
        f"{CATEGORY} AS category_id",
    )


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        events=bronze(spark, sf_dir),
        categories=categories(spark, sf_dir),
        brands=brands(spark, sf_dir),
        items=items(spark, sf_dir),
        locations=locations(spark, sf_dir),
    )


# Read the same by Spark and by DuckDB.
BRAND = "CAST(substr(p_brand, 7) AS INT)"
CATEGORY = "ascii(substr(p_type, 1, 1)) * 100 + ascii(substr(p_type, 2, 1))"

STEP_ROWS = ", ".join(f"({i}, '{t}')" for i, t in enumerate(STEPS))

EVENTS_CTE = f"""
steps(sequence, event_type) AS (VALUES {STEP_ROWS}),
copies(dup) AS (VALUES (0), (1)),
expanded AS (
  SELECT *, o_orderdate + to_seconds((o_orderkey % 1440) * 60 + sequence * 600
         + (o_orderkey * 7 + sequence * 13) % 300 + dup * (o_orderkey % 2) * 5) AS moment
  FROM orders
  JOIN steps ON sequence <= CASE o_orderstatus WHEN 'F' THEN 7 WHEN 'P' THEN 6 ELSE 3 END
  JOIN copies ON dup = 0 OR (o_orderkey % 41 = 0 AND sequence = 0)
),
bronze AS (
  SELECT CAST(o_orderkey AS VARCHAR) || '-' || CAST(sequence AS VARCHAR) AS event_id,
    event_type,
    strftime(moment, '%Y-%m-%dT%H:%M:%S') AS ts,
    CAST(epoch(moment) AS BIGINT) AS ts_seconds,
    CASE WHEN o_orderkey % 50 = 0 OR (o_orderkey % 53 = 0 AND sequence = 1) THEN NULL
         ELSE CAST(o_custkey % 4 + 1 AS INTEGER) END AS location_id,
    CASE WHEN o_orderkey % 71 = 0 AND sequence = 2 THEN NULL
         ELSE 'O' || CAST(o_orderkey AS VARCHAR) END AS order_id,
    sequence,
    CASE WHEN sequence = 1 AND o_orderkey % 101 = 0 THEN '{{"kitchen_id": 1}} x'
         WHEN sequence = 2 AND o_orderkey % 103 = 0 THEN ''
         WHEN event_type = 'driver_ping' THEN '{{"lat": ' || CAST(o_orderkey % 90 AS VARCHAR)
              || '.5, "lon": 7.25, "driver_id": "D' || CAST(o_orderkey % 500 AS VARCHAR) || '"}}'
         WHEN event_type = 'driver_arrived' THEN '{{"driver_id": "D' || CAST(o_orderkey % 500 AS VARCHAR) || '"}}'
         WHEN sequence <> 0 THEN '{{}}'
         WHEN o_orderkey % 97 = 0 THEN '{{"brand_id": 3, "tot'
         ELSE '{{"brand_id": ' || CAST(o_orderkey % 20 + 1 AS VARCHAR) || ', "total": '
              || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || '}}' END AS body,
    moment AS event_timestamp
  FROM expanded
)"""

DIMS_CTE = f"""
locations AS (SELECT r_regionkey AS id, r_name AS city FROM region),
brands AS (SELECT DISTINCT {BRAND} AS id, p_brand AS name FROM part),
categories AS (SELECT DISTINCT {CATEGORY} AS id, p_type AS name FROM part),
items AS (SELECT p_partkey AS id, {BRAND} AS brand_id, p_name AS name,
          p_retailprice AS price, {CATEGORY} AS category_id FROM part)"""

ENRICHED_CTE = """
enriched AS (
  SELECT b.*, l.city AS city_name,
    CASE WHEN json_valid(body) THEN CAST(json_extract_string(body, '$.brand_id') AS INTEGER) END AS brand_id,
    CASE WHEN json_valid(body) THEN CAST(json_extract_string(body, '$.total') AS DOUBLE) END AS order_total,
    CASE WHEN json_valid(body) THEN CAST(json_extract_string(body, '$.lat') AS DOUBLE) END AS latitude,
    CASE WHEN json_valid(body) THEN json_extract_string(body, '$.driver_id') END AS driver_id,
    CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
    CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS event_day_of_week,
    dayofweek(event_timestamp) IN (0, 6) AS is_weekend,
    CAST(event_timestamp AS DATE) AS event_date
  FROM bronze b LEFT JOIN locations l ON l.id = b.location_id
  WHERE event_id IS NOT NULL AND order_id IS NOT NULL AND event_timestamp IS NOT NULL
)"""

LIFECYCLE_CTE = """
milestones AS (
  SELECT order_id, location_id, city_name,
    min(event_timestamp) FILTER (event_type = 'order_created') AS created_at,
    min(event_timestamp) FILTER (event_type = 'kitchen_started') AS kitchen_started_at,
    min(event_timestamp) FILTER (event_type = 'kitchen_finished') AS kitchen_finished_at,
    min(event_timestamp) FILTER (event_type = 'order_ready') AS order_ready_at,
    min(event_timestamp) FILTER (event_type = 'driver_arrived') AS driver_arrived_at,
    min(event_timestamp) FILTER (event_type = 'driver_picked_up') AS pickup_at,
    min(event_timestamp) FILTER (event_type = 'delivered') AS delivered_at
  FROM enriched GROUP BY order_id, location_id, city_name
),
lifecycle AS (
  SELECT *,
    CAST(epoch(kitchen_finished_at) - epoch(kitchen_started_at) AS BIGINT) / 60.0::DOUBLE AS kitchen_duration_min,
    CAST(epoch(delivered_at) - epoch(pickup_at) AS BIGINT) / 60.0::DOUBLE AS delivery_duration_min,
    CAST(epoch(delivered_at) - epoch(created_at) AS BIGINT) / 60.0::DOUBLE AS total_duration_min
  FROM milestones WHERE delivered_at IS NOT NULL
)"""

BRONZE_SQL = f"WITH {EVENTS_CTE}"
SILVER_SQL = f"WITH {EVENTS_CTE}, {DIMS_CTE}, {ENRICHED_CTE}"
LIFECYCLE_SQL = f"{SILVER_SQL}, {LIFECYCLE_CTE}"
