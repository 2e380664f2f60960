"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalogue.registry import doubles, query, table
from orderloom.functions.payload import json_value, unpack
from orderloom.functions.times import (
    MICROS,
    calendar_features,
    minutes_between,
    patterned_timestamp,
    tolerant_timestamp,
)
from orderloom.operators.rows import add_columns

ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("text", F.date_format("ts", MICROS))


@query(
    "F2 F4",
    f"SELECT event_id, {ISO_SQL} AS text, ts AS by_pattern, ts AS by_default FROM events",
)
def parsed_timestamps(spark, sf_dir):
    text = F.col("text")
    return _events(spark, sf_dir).select(
        "event_id", "text",
        patterned_timestamp(text).alias("by_pattern"),
        F.to_timestamp(text).alias("by_default"),
    )


@query(
    "S4 F3",
    f"""SELECT event_id, text, coalesce(try_strptime(text, '%Y-%m-%dT%H:%M:%S.%f'),
          try_strptime(text, '%Y-%m-%dT%H:%M:%S')) AS event_timestamp
        FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN {ISO_SQL}
          WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE 'no time ' || event_id END AS text FROM events)""",
)
def tolerant_timestamps(spark, sf_dir):
    """A third with fraction, a third without, a third unreadable."""
    third = F.col("event_id") % 3
    text = (
        F.when(third == 0, F.col("text"))
        .when(third == 1, F.substring("text", 1, 19))
        .otherwise(F.concat(F.lit("no time "), F.col("event_id").cast("string")))
    )
    mixed = _events(spark, sf_dir).select("event_id", text.alias("text"))
    return mixed.withColumn("event_timestamp", tolerant_timestamp(F.col("text")))


@query(
    "F5 F6 F8 F10",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS event_hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS event_day_of_week,
         dayofweek(ts) IN (0, 6) AS is_weekend, CAST(ts AS DATE) AS event_date,
         date_trunc('day', ts)::TIMESTAMP AS event_day, CAST(ts AS DATE) >= DATE '2024-01-15' AS second_half
       FROM events""",
)
def calendar(spark, sf_dir):
    features = calendar_features(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        *(c.alias(name) for name, c in features.items()),
        F.date_trunc("day", "ts").alias("event_day"),
        (F.to_date("ts") >= F.to_date(F.lit("2024-01-15"))).alias("second_half"),
    )


@query(
    "F7",
    """SELECT l_orderkey, l_linenumber,
         CAST(epoch(l_shipdate) - epoch(o_orderdate) AS BIGINT) / 60.0::DOUBLE AS minutes
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def minutes_to_ship(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    placed = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_orderdate")
    return lines.join(placed, "l_orderkey").select(
        "l_orderkey",
        "l_linenumber",
        minutes_between(F.col("l_shipdate"), F.col("o_orderdate")).alias("minutes"),
    )


@query(
    "F11 F12 F13 P6 P7 P9",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_value,
         CAST(NULL AS VARCHAR) AS absent FROM events""",
)
def json_fields(spark, sf_dir):
    """The same key once through a schema and once through a path."""
    events = table(spark, sf_dir, "events")
    parsed = unpack(events, F.col("props"), "k int", "event_id", "props")
    return parsed.select(
        "event_id",
        "k",
        json_value(F.col("props"), "$.k", "double").alias("k_value"),
        F.get_json_object("props", "$.absent").alias("absent"),
    )


@query(
    "F14 F15 F16",
    """SELECT p_partkey, replace(p_brand, 'Brand#', 'B-') AS brand,
         p_name || ' / ' || CAST(p_size AS VARCHAR) AS label, p_size % 7 AS size_class FROM part""",
)
def text_and_modulo(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.regexp_replace("p_brand", "^Brand#", "B-").alias("brand"),
        F.concat("p_name", F.lit(" / "), F.col("p_size").cast("string")).alias("label"),
        (F.col("p_size") % 7).alias("size_class"),
    )


@query(
    "F17 P9",
    """SELECT event_id, CAST(round(CAST(value AS DECIMAL(10,2)), 1) AS DOUBLE) AS tenth,
         CAST(round(CAST(value AS DECIMAL(10,2)), 0) AS DOUBLE) AS whole FROM events""",
)
def rounding(spark, sf_dir):
    """Half up, on exact decimals."""
    amount = F.col("value").cast("decimal(10,2)")
    rounded = table(spark, sf_dir, "events").select(
        "event_id", F.round(amount, 1).alias("tenth"), F.round(amount, 0).alias("whole")
    )
    return doubles(rounded, "tenth", "whole")


@query(
    "F9 F18 P4 P10",
    "SELECT event_id, 'loaded' AS source, true AS dated, true AS keyed FROM events",
)
def ingest_columns(spark, sf_dir):
    """Literal, ingest time and random key; the last two only as being there."""
    stamped = table(spark, sf_dir, "events").withColumns(
        {"source": F.lit("loaded"), "ingested_at": F.current_timestamp(), "row_key": F.expr("uuid()")}
    )
    return stamped.select(
        "event_id",
        "source",
        F.col("ingested_at").isNotNull().alias("dated"),
        (F.length("row_key") == 36).alias("keyed"),
    )


@query(
    "D8",
    "SELECT o_orderkey, o_orderstatus, CAST(NULL AS DOUBLE) AS tip_amount FROM orders",
)
def added_column(spark, sf_dir):
    """A new column is NULL in every row that exists."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return add_columns(rows, tip_amount="double")
