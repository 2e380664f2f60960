"""The sales layers as SQL statements over stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def create_as(
    spark: SparkSession, target: str, query: str, provider: str = "parquet", measures: dict[str, Column] | None = None
) -> DataFrame | tuple[DataFrame, dict]:
    """CREATE TABLE ... AS; replaces a table of that name once the new one is complete.

    With `measures`, aggregates of the rows as they are written come back beside the table.
    """
    fresh, seen = f"{target}_{uuid.uuid4().hex[:8]}", Observation()
    if measures:
        rows = spark.sql(query).observe(seen, *(c.alias(k) for k, c in measures.items()))
        rows.write.format(provider).saveAsTable(fresh)
    else:
        spark.sql(f"CREATE TABLE {fresh} USING {provider} AS {query}")
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {target}")
    return (spark.table(target), seen.get) if measures else spark.table(target)


def silver_sales(spark: SparkSession, bronze: str, target: str, measures: dict[str, Column] | None = None):
    """Sales with an order, their time parsed into timestamp, date and hour."""
    return create_as(
        spark,
        target,
        f"""WITH timed AS (
              SELECT order_id, customer_id, product_id, product_name, quantity, unit_price,
                     total, to_timestamp(timestamp) AS order_timestamp, ingested_at
              FROM {bronze} WHERE order_id IS NOT NULL)
            SELECT *, date(order_timestamp) AS order_date, hour(order_timestamp) AS order_hour,
                   current_timestamp() AS processed_at
            FROM timed""",
        measures=measures,
    )


def _per_customer(source: str, total: str, moment: str, *more: str) -> str:
    """Customers with their orders, revenue and time span. Names and order of the columns."""
    columns = [
        "customer_id",
        "count(*) AS total_orders",
        f"sum(total) AS {total}",
        "avg(total) AS avg_order_value",
        f"min({moment}) AS first_order",
        f"max({moment}) AS last_order",
        *more,
    ]
    return f"SELECT {', '.join(columns)} FROM {source} GROUP BY customer_id"


def gold_customers(spark: SparkSession, silver: str, target: str, measures: dict[str, Column] | None = None):
    """Customers with revenue, time span and number of different products."""
    more = ("count(DISTINCT product_id) AS unique_products", "current_timestamp() AS aggregated_at")
    return create_as(spark, target, _per_customer(silver, "total_revenue", "order_timestamp", *more), measures=measures)


def customer_summary(spark: SparkSession, orders: str, target: str) -> DataFrame:
    """Customers by order date, amounts as stored."""
    return create_as(spark, target, _per_customer(orders, "total_spent", "order_date"))


def insert_orders_from_raw(spark: SparkSession, raw: str, target: str) -> None:
    """Order events out of raw JSON rows; other events and fields are left behind."""
    spark.sql(
        f"""INSERT INTO {target}
            SELECT raw_data.order_id, try_cast(raw_data.amount AS DOUBLE), current_timestamp()
            FROM (SELECT from_json(raw_data, 'order_id STRING, amount STRING') AS raw_data
                  FROM {raw} WHERE event_type = 'order')"""
    )


def insert_order_totals(spark: SparkSession, orders: str, target: str) -> None:
    spark.sql(
        f"""INSERT INTO {target}
            SELECT count(*), sum(amount), avg(amount), current_timestamp() FROM {orders}"""
    )
