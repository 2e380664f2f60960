"""Data-quality queries over the event log and its tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalogue import fixture
from orderloom.catalogue.fixture import BRONZE_SQL, DIMS_CTE, SILVER_SQL
from orderloom.catalogue.medallion import HOURLY_SQL, enriched
from orderloom.catalogue.registry import doubles, money, query, sum_of_cents, table
from orderloom.operators import quality
from orderloom.operators.running import behind_running_max
from orderloom.plans import gold
from orderloom.schemas import EVENT_TYPES


@query(
    "Q1",
    f"""{BRONZE_SQL} SELECT 'event_id' AS column_name, count(event_id) AS filled, true AS present FROM bronze
        UNION ALL SELECT 'order_id', count(order_id), true FROM bronze
        UNION ALL SELECT 'location_id', count(location_id), true FROM bronze
        UNION ALL SELECT 'body', count(body), true FROM bronze
        UNION ALL SELECT 'driver_id', 0, false""",
)
def required_columns(spark, sf_dir):
    wanted = ["event_id", "order_id", "location_id", "body", "driver_id"]
    return quality.column_presence(fixture.event_log(spark, sf_dir), wanted)


@query(
    "Q2",
    f"""{SILVER_SQL}, shares AS (
          SELECT count(*) AS n, count(event_timestamp) AS t, count(city_name) AS c,
            count(*) FILTER (event_type = 'order_created') AS n_created,
            count(brand_id) FILTER (event_type = 'order_created') AS b FROM enriched)
        SELECT 'event_timestamp' AS column_name, (n - t) / n::DOUBLE AS null_ratio, (n - t) / n::DOUBLE < 0.01 AS passed FROM shares
        UNION ALL SELECT 'city_name', (n - c) / n::DOUBLE, (n - c) / n::DOUBLE < 0.05 FROM shares
        UNION ALL SELECT 'brand_id', (n_created - b) / n_created::DOUBLE, (n_created - b) / n_created::DOUBLE < 0.05 FROM shares""",
)
def null_ratios(spark, sf_dir):
    """Tolerated: 1% without time, 5% without city, 5% of created orders without brand."""
    tolerances = {"event_timestamp": 0.01, "city_name": 0.05, "brand_id": 0.05}
    created = F.col("event_type") == "order_created"
    return quality.null_ratios(enriched(spark, sf_dir), tolerances, only={"brand_id": created})


@query(
    "Q3",
    f"""{BRONZE_SQL} SELECT count(*) AS rows, count(*) FILTER (event_id IS NOT NULL
          AND order_id IS NOT NULL AND event_timestamp IS NOT NULL) AS kept FROM bronze""",
)
def null_filter_effect(spark, sf_dir):
    complete = F.expr("event_id IS NOT NULL AND order_id IS NOT NULL AND event_timestamp IS NOT NULL")
    return quality.filter_effect(fixture.bronze(spark, sf_dir), complete)


@query(
    "Q4",
    f"""WITH {DIMS_CTE} SELECT 'brands' AS table_name, 25::BIGINT AS expected, count(*) AS actual,
          count(*) = 25 AS passed FROM brands
        UNION ALL SELECT 'locations', 4::BIGINT, count(*), count(*) = 4 FROM locations""",
)
def dimension_cardinality(spark, sf_dir):
    """The brands are all there; one location more than expected is reported."""
    return quality.cardinalities(
        {"brands": (fixture.brands(spark, sf_dir), 25), "locations": (fixture.locations(spark, sf_dir), 4)}
    )


def _checked(column: str, passed: str, source: str, value: str | None = None) -> str:
    value = value or column
    return f"""SELECT '{column}' AS column_name, min({value})::DOUBLE AS lowest, max({value})::DOUBLE AS highest,
          round(avg({value}), 4) AS mean, {passed} AS passed FROM {source}"""


@query(
    "Q5",
    f"""{SILVER_SQL}, hourly AS ({HOURLY_SQL}), totals AS (
          SELECT order_total FROM enriched WHERE event_type = 'order_created')
        {_checked("event_hour", "min(event_hour) >= 0 AND max(event_hour) <= 23", "hourly")}
        UNION ALL {_checked("order_count", "min(order_count) >= 1", "hourly")}
        UNION ALL {_checked("unique_brands", "max(unique_brands) <= 20", "hourly")}
        UNION ALL {_checked("total_revenue", "min(total_revenue) > 0", "hourly")}
        UNION ALL {_checked("avg_order_value", "min(avg_order_value) >= 5 AND max(avg_order_value) <= 200", "hourly")}
        UNION ALL {_checked("order_total", "min(order_total) > 0 AND max(order_total) < 1000 AND avg(order_total) > 10 AND avg(order_total) < 100", "totals")}
        UNION ALL {_checked("meal_total", "min(order_total / 5000) >= 0 AND avg(order_total / 5000) > 10 AND avg(order_total / 5000) < 100", "totals", "order_total / 5000")}""",
)
def range_checks(spark, sf_dir):
    """These orders are worth far more than a meal, so the value checks report them; in other money the mean passes."""
    events = enriched(spark, sf_dir)
    hourly = quality.range_checks(
        gold.hourly_metrics(events),
        {
            "event_hour": (0, 23),
            "order_count": (1, None),
            "unique_brands": (None, 20),
            "total_revenue": (0, None),
            "avg_order_value": (5, 200),
        },
        exclusive=("total_revenue",),
    )
    created = gold.created(events).withColumn("meal_total", F.col("order_total").cast("double") / 5000)
    totals = quality.range_checks(
        created, {"order_total": (0, 1000), "meal_total": (0, None)}, ("order_total",),
        means={"order_total": (10, 100), "meal_total": (10, 100)},
    )
    return hourly.unionByName(totals).withColumn("mean", F.round("mean", 4))


@query(
    "Q6",
    f"""{BRONZE_SQL} SELECT event_id, event_type FROM bronze WHERE order_id IS NULL OR length(order_id) = 0""",
)
def blank_order_ids(spark, sf_dir):
    return quality.blank_ids(fixture.event_log(spark, sf_dir), "order_id").select("event_id", "event_type")


@query(
    "Q8",
    f"{BRONZE_SQL} SELECT event_id, body FROM bronze WHERE NOT json_valid(body)",
)
def malformed_bodies(spark, sf_dir):
    _, bad = quality.quarantine(fixture.event_log(spark, sf_dir))
    return bad.select("event_id", "body")


@query(
    "Q8",
    f"""{BRONZE_SQL} SELECT event_type, count(*) AS events FROM bronze WHERE json_valid(body) GROUP BY event_type""",
)
def readable_bodies(spark, sf_dir):
    good, _ = quality.quarantine(fixture.event_log(spark, sf_dir))
    return good.groupBy("event_type").agg(F.count("*").alias("events"))


@query(
    "Q9",
    f"{BRONZE_SQL} SELECT event_id, count(*) AS copies FROM bronze GROUP BY event_id HAVING count(*) > 1",
)
def duplicate_events(spark, sf_dir):
    return quality.duplicates(fixture.event_log(spark, sf_dir), "event_id")


LATE_SQL = """SELECT event_id, event_type, ts, latest_before FROM (
  SELECT *, max(ts) OVER (PARTITION BY event_type ORDER BY arrival
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest_before
  FROM (SELECT *, event_id * 100 + CASE WHEN event_id % 31 = 0 THEN 2901 ELSE 0 END AS arrival FROM events))
  WHERE ts < latest_before"""


@query("Q10", LATE_SQL)
def out_of_order_events(spark, sf_dir):
    """Every 31st event arrives 29 places late; five hot keys hold all rows."""
    late = F.when(F.col("event_id") % 31 == 0, 2901).otherwise(0)
    arrived = table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts", (F.col("event_id") * 100 + late).alias("arrival")
    )
    return behind_running_max(arrived, "event_type", "arrival", "ts").drop("arrival")


@query(
    "Q11",
    f"""{BRONZE_SQL}, parsed AS (
          SELECT *, CASE WHEN json_valid(body) THEN json_extract_string(body, '$.brand_id') END AS brand_id,
            CASE WHEN json_valid(body) THEN json_extract_string(body, '$.total') END AS total FROM bronze)
        SELECT 'order_id' AS field, count(*) - count(order_id) AS nulls FROM parsed
        UNION ALL SELECT 'location_id', count(*) - count(location_id) FROM parsed
        UNION ALL SELECT 'body_brand_id', count(*) - count(brand_id) FROM parsed
        UNION ALL SELECT 'body_total', count(*) - count(total) FROM parsed""",
)
def null_profile(spark, sf_dir):
    events = fixture.event_log(spark, sf_dir)
    return quality.null_profile(events, ["order_id", "location_id"], ["brand_id", "total"])


@query(
    "U2",
    f"""{BRONZE_SQL} SELECT DISTINCT event_type FROM bronze
        WHERE event_type NOT IN ('order_created', 'kitchen_started', 'delivered')""",
)
def unexpected_event_types(spark, sf_dir):
    """Types outside a shortened set; against the full set nothing is left."""
    valid = [t for t in EVENT_TYPES if t in ("order_created", "kitchen_started", "delivered")]
    return quality.unknown_values(fixture.event_log(spark, sf_dir), "event_type", valid)


@query(
    "Q7",
    f"""WITH per_supplier AS (SELECT CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_suppkey)
        SELECT count(*) AS bronze_rows, count(l_orderkey) AS silver_rows, {sum_of_cents("l_extendedprice")} AS bronze_total,
          {sum_of_cents("l_extendedprice")} AS silver_total, (SELECT CAST(sum(cents) AS BIGINT) / 100.0::DOUBLE FROM per_supplier) AS gold_total,
          count(*) = count(l_orderkey) AS counts_match,
          abs({sum_of_cents("l_extendedprice")} - (SELECT CAST(sum(cents) AS BIGINT) / 100.0::DOUBLE FROM per_supplier)) < 0.01 AS totals_match FROM lineitem""",
)
def layer_reconciliation(spark, sf_dir):
    """Lines, lines with an order, and their sums per supplier hold the same money."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", money("l_extendedprice").alias("total")
    )
    silver = lines.where(F.col("l_orderkey").isNotNull())
    per_supplier = silver.groupBy("l_suppkey").agg(F.sum("total").alias("total_revenue"))
    return doubles(
        quality.reconcile(lines, silver, per_supplier, "total", "total_revenue"), "bronze_total"
    )
