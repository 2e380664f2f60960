"""Streaming queries, run to the end of the given tables.

Every stream reads files and writes files in the shared folder; what comes back
is a batch frame over the written result. Running totals are updated batch by batch, without
a watermark, and lose no row in whatever order the files come. Windows that are given out
once they are closed need rows that arrive about in the order of time, as they do in
a log: the events come week by week, each run of the stream takes what has come
since the last one, and the windows that end within the patience of the newest event are
still open at the end.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from orderloom.catalogue import fixture
from orderloom.catalogue.fixture import BRONZE_SQL, EVENTS_CTE
from orderloom.catalogue.registry import doubles, money, query, table
from orderloom.functions.payload import unpack
from orderloom.functions.times import MICROS
from orderloom.operators.quality import repeated_ids
from orderloom.session import work_area
from orderloom.sources.messages import (
    EVENT_MESSAGE,
    append_messages,
    between,
    folder_batch,
    folder_stream,
    latest_position,
    value_text,
)
from orderloom.sources.synthetic import click_events
from orderloom.streaming import bronze, windows
from orderloom.streaming.runs import (
    append_progress,
    append_to_files,
    append_to_table,
    drain,
    finish,
    last_values,
    measured,
    open_state,
    table_stream,
    update_files,
)
from orderloom.tables.ddl import by_hour


# A topic's folder is read in batches of so many files, so no batch takes all of a long log.
FILES_PER_BATCH = 256


def _topic(spark, events, key, columns, moment, folder=None) -> str:
    """A folder holding the rows as messages: binary key and value, timestamp."""
    area = folder or work_area(spark, "topic")
    sent = events.withColumn("sent_at", F.to_timestamp(F.col(moment)))
    append_messages(sent, area, "sent_at", lambda rows: _messages(rows, key, columns, F.col("sent_at")))
    return area


def _messages(rows, key, columns, sent_at):
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return rows.select(
        F.col(key).cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"), sent_at.alias("timestamp")
    )


def _order_topic(spark, sf_dir) -> str:
    """A folder holding the order events as messages."""
    area = work_area(spark, "topic")
    append_messages(fixture.steps(spark, sf_dir), area, "moment", _order_messages)
    return area


def _order_messages(steps):
    return _messages(fixture.described(steps), "order_id", EVENT_MESSAGE, F.timestamp_seconds("ts_seconds"))


def _order_stream(spark, sf_dir):
    return folder_stream(spark, _order_topic(spark, sf_dir), files_per_batch=FILES_PER_BATCH)


def given_stream(spark, sf_dir, name):
    """A given table as a stream, whether it is one file or a folder of them."""
    return folder_stream(spark, f"{sf_dir}/{name}.parquet", table(spark, sf_dir, name).schema, FILES_PER_BATCH)


def _given_events(spark, sf_dir):
    """The `events` table as a stream, its time with zone as watermarks need it."""
    return given_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _written(spark, stream, purpose):
    """Run the stream to its end into a folder, then read the folder."""
    area = work_area(spark, purpose)
    finish(append_to_files(stream, f"{area}/rows", f"{area}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{area}/rows")


def _updated(spark, stream, keys, purpose):
    """Run an aggregating stream to its end in update mode; the last value of every key."""
    area = work_area(spark, purpose)
    finish(update_files(stream, f"{area}/rows", f"{area}/checkpoint"))
    return last_values(spark, f"{area}/rows", stream.schema, keys)


def _weeks(spark, sf_dir) -> list[datetime]:
    """The weeks of the given events, in order."""
    weeks = table(spark, sf_dir, "events").select(F.date_trunc("week", "ts").alias("week")).distinct()
    return sorted(r.week for r in weeks.collect() if r.week is not None)


def _week_of_events(spark, sf_dir, week):
    """The given events of one week, `ts` with zone as watermarks need it."""
    moment = F.col("ts")
    first, last = (F.lit(t).cast("timestamp_ntz") for t in (week, week + timedelta(days=7)))
    events = table(spark, sf_dir, "events").where((moment >= first) & (moment < last))
    return events.withColumn("ts", moment.cast("timestamp"))


def _arriving(spark, sf_dir, counts, shape, purpose):
    """Windows over events that arrive week by week, one run of the stream after each.

    Gives the folder of closed windows, and of every run its reports and the rows left open.
    A run takes a whole week as one batch, so no row of it comes after a watermark that
    other rows of the week have moved.
    """
    area = work_area(spark, purpose)
    runs = []
    for week in _weeks(spark, sf_dir):
        rows = shape(_week_of_events(spark, sf_dir, week))
        rows.write.mode("append").parquet(f"{area}/arrived")
        stream = counts(folder_stream(spark, f"{area}/arrived", rows.schema))
        reports = finish(append_to_files(stream, f"{area}/closed", f"{area}/checkpoint"))
        runs.append((week, reports, open_state(spark, f"{area}/checkpoint").count()))
    return spark.read.schema(stream.schema).parquet(f"{area}/closed"), runs


def _schema(spark) -> str:
    """A schema of its own, stored in the shared folder."""
    name = f"loom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{work_area(spark, 'schema')}'")
    return name


@query(
    "T1 P7 F11",
    f"""{BRONZE_SQL} SELECT event_id, event_type, ts, CAST(ts_seconds AS INTEGER) AS ts_seconds,
          location_id, order_id, sequence, body, event_timestamp AS kafka_timestamp, event_timestamp
        FROM bronze""",
)
def stream_bronze(spark, sf_dir):
    """Messages to the bronze streaming table."""
    return _written(spark, bronze.order_events(_order_stream(spark, sf_dir)), "stream-bronze")


@query(
    "T2 F12",
    f"""{BRONZE_SQL} SELECT event_id, event_type, order_id, location_id, ts FROM bronze
        WHERE event_type = 'order_created'""",
)
def stream_created_orders(spark, sf_dir):
    return _written(spark, bronze.created_orders(_order_stream(spark, sf_dir)), "stream-created")


@query(
    "T1",
    f"{BRONZE_SQL} SELECT event_type, count(*) AS events FROM bronze GROUP BY event_type",
)
def message_batch(spark, sf_dir):
    """The same messages read as a batch, from the earliest to the latest."""
    return bronze.order_events(folder_batch(spark, _order_topic(spark, sf_dir))).groupBy("event_type").agg(F.count("*").alias("events"))


def windows_sql(size: str, key: str, measures: str, source: str = "events", closed: str = "") -> str:
    """SQL for tumbling windows; `closed` leaves those that end within it of the newest event."""
    where = f"""WHERE window_start + INTERVAL '{size}'
              <= (SELECT date_trunc('milliseconds', max(ts)) FROM {source}) - INTERVAL '{closed}'""" if closed else ""
    return f"""
        SELECT window_start, window_start + INTERVAL '{size}' AS window_end, {key}, {measures}
        FROM (SELECT *, time_bucket(INTERVAL '{size}', ts) AS window_start FROM {source})
        {where}
        GROUP BY window_start, {key}"""


WINDOW = ["window_start", "window_end"]


@query(
    "T3 S12",
    windows_sql(
        "10 seconds", "event_type",
        "count(*) AS count, CAST(sum(event_id * 10) AS BIGINT) AS total_value",
        "(SELECT ts, event_id, CASE WHEN event_id % 2 = 0 THEN 'click' ELSE 'view' END AS event_type FROM events)",
    ),
)
def stream_type_totals(spark, sf_dir):
    """Synthetic clicks counted every ten seconds."""
    ticks = _given_events(spark, sf_dir).selectExpr("ts AS timestamp", "event_id AS value")
    return _updated(spark, windows.type_totals(click_events(ticks)), [*WINDOW, "event_type"], "stream-types")


PRODUCTS_SQL = "(SELECT *, 'P' || CAST(user_id % 20 AS VARCHAR) AS product FROM events)"


@query(
    "T4 F2 P3",
    windows_sql(
        "30 seconds", "product",
        "count(*) AS event_count, round(sum(value * (event_id % 5 + 1)), 2) AS total_revenue", PRODUCTS_SQL,
    ),
)
def stream_product_revenue(spark, sf_dir):
    """Click messages to revenue per product every thirty seconds."""
    clicks = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", MICROS).alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.concat(F.lit("P"), (F.col("user_id") % 20).cast("string")).alias("product"),
        F.col("value").alias("price"),
        (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
    )
    folder = _topic(spark, clicks, "user_id", clicks.columns, "timestamp")
    parsed = bronze.clicks(folder_stream(spark, folder, files_per_batch=FILES_PER_BATCH))
    counted = _updated(spark, windows.product_revenue(parsed), [*WINDOW, "product"], "stream-products")
    return counted.withColumn("total_revenue", F.round("total_revenue", 2))


CATEGORIES_SQL = "(SELECT ts, 'C' || CAST(user_id % 7 AS VARCHAR) AS category FROM events)"


def _types(events):
    return events.select("ts", "event_type")


def _categories(events):
    category = F.concat(F.lit("C"), (F.col("user_id") % 7).cast("string"))
    return events.select(F.col("ts").alias("event_time"), category.alias("category"))


@query("T5", windows_sql("5 minutes", "event_type", "count(*) AS count", closed="10 minutes"))
def stream_type_counts(spark, sf_dir):
    """Windows given out when the watermark, ten minutes behind the newest event, has closed them."""
    return _arriving(spark, sf_dir, windows.type_counts, _types, "stream-counts")[0]


@query("T6", windows_sql("10 minutes", "category", "count(*) AS count", CATEGORIES_SQL, closed="1 hour"))
def stream_category_counts(spark, sf_dir):
    """Windows given out when the watermark, an hour behind the newest event, has closed them."""
    return _arriving(spark, sf_dir, windows.category_counts, _categories, "stream-categories")[0]


@query(
    "T5 T6",
    """WITH weeks AS (SELECT DISTINCT date_trunc('week', ts) AS week FROM events WHERE ts IS NOT NULL),
    marks AS (SELECT w.week, date_trunc('milliseconds', max(e.ts)) - INTERVAL '10 minutes' AS mark
              FROM weeks w JOIN events e ON e.ts < w.week + INTERVAL '7 days' GROUP BY w.week),
    cells AS (SELECT time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end, event_type, min(ts) AS first
              FROM events GROUP BY ALL)
    SELECT CAST(week AS TIMESTAMP) AS week,
      (SELECT count(*) FROM events e WHERE date_trunc('week', e.ts) = m.week) AS arrived, CAST(0 AS BIGINT) AS late,
      (SELECT count(*) FROM cells c WHERE c.first < m.week + INTERVAL '7 days' AND c.window_end > m.mark) AS open_windows
    FROM marks m""",
)
def stream_open_windows(spark, sf_dir):
    """Of the five-minute counts after each week: rows that came, rows too late, and the windows still in the state."""
    _, runs = _arriving(spark, sf_dir, windows.type_counts, _types, "stream-open")
    rows = [(week, sum(r["rows"] for r in reports), sum(r["late_rows"] for r in reports), left) for week, reports, left in runs]
    return spark.createDataFrame(rows, "week timestamp_ntz, arrived long, late long, open_windows long")


def _half(spark, sf_dir) -> datetime:
    """Noon of the middle day of the given events."""
    span = table(spark, sf_dir, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    days = F.floor((F.unix_micros(F.col("last").cast("timestamp")) - F.unix_micros(F.col("first").cast("timestamp"))) / (2 * 86_400_000_000))
    row = span.select(F.to_date("first").alias("day"), days.alias("days")).first()
    return datetime(row.day.year, row.day.month, row.day.day, 12) + timedelta(days=row.days)


HALF_SQL = """half AS (SELECT date_trunc('day', min(ts)) + INTERVAL '12 hours'
  + to_days(CAST((epoch_us(max(ts)) - epoch_us(min(ts))) // 172800000000 AS INTEGER)) AS moment FROM events)"""


ACTION = ["event_id", "event_type", "user_id"]


def _actions(spark, sf_dir):
    """What the messages of the given events tell, and when they are sent."""
    return table(spark, sf_dir, "events").select(*ACTION, F.col("ts").cast("timestamp").alias("timestamp"))


@query(
    "S9",
    f"""WITH {HALF_SQL} SELECT event_type, count(*) AS events, min(ts) AS first_at, max(ts) AS last_at FROM events, half
        WHERE ts >= moment - INTERVAL '3 days' AND ts < moment GROUP BY event_type""",
)
def messages_between(spark, sf_dir):
    """A topic as a batch from one position to another: three days of it."""
    folder, end = work_area(spark, "topic"), _half(spark, sf_dir)
    _topic(spark, _actions(spark, sf_dir), "event_id", ACTION, "timestamp", folder)
    part = folder_batch(spark, folder, end - timedelta(days=3), end)
    fields = unpack(part, value_text(), "event_type string", "timestamp")
    return fields.groupBy("event_type").agg(
        F.count("*").alias("events"), F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at")
    )


def _followed(spark, sf_dir, earliest: bool):
    """A reader that comes when half of the events are there, and follows what arrives after."""
    folder, area, half = work_area(spark, "topic"), work_area(spark, "followed"), _half(spark, sf_dir)
    sent = _actions(spark, sf_dir)
    _topic(spark, between(sent, end=half), "event_id", ACTION, "timestamp", folder)
    start = None if earliest else latest_position(spark, folder)
    for arrived in (None, between(sent, start=half)):
        if arrived is not None:
            _topic(spark, arrived, "event_id", ACTION, "timestamp", folder)
        messages = between(folder_stream(spark, folder, files_per_batch=FILES_PER_BATCH), start)
        parsed = unpack(messages, value_text(), "event_id long, event_type string, user_id long", "timestamp")
        finish(append_to_files(parsed, f"{area}/rows", f"{area}/checkpoint"))
    return spark.read.schema(parsed.schema).parquet(f"{area}/rows")


@query("S8", "SELECT event_id, event_type, user_id, ts AS timestamp FROM events WHERE ts IS NOT NULL")
def stream_from_earliest(spark, sf_dir):
    """From the first message on; files that are gone are passed over."""
    return _followed(spark, sf_dir, earliest=True)


@query("S7", f"WITH {HALF_SQL} SELECT event_id, event_type, user_id, ts AS timestamp FROM events, half WHERE ts >= moment")
def stream_from_latest(spark, sf_dir):
    """Only what arrives once the reader is there."""
    return _followed(spark, sf_dir, earliest=False)


PROGRESS = "seen long, purchases long, cents long, first_at long, last_at long"


@query(
    "T12 T8",
    """SELECT part, count(*) AS rows, count(*) AS seen, count(*) FILTER (event_type = 'purchase') AS purchases,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, min(ts) AS first_at, max(ts) AS last_at
       FROM (SELECT *, CAST(event_id % 2 AS INTEGER) AS part FROM events) GROUP BY part""",
)
def stream_progress(spark, sf_dir):
    """A stream by the second, stopped when half of the rows are through and gone on: what its progress reports say.

    The figures of each batch are taken as its rows pass, and kept as a table.
    """
    area = work_area(spark, "progress")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for part in range(2):
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{area}/arrived")
        stream = measured(
            folder_stream(spark, f"{area}/arrived", events.schema, FILES_PER_BATCH),
            "passed",
            seen=F.count(F.lit(1)),
            purchases=F.count_if(F.col("event_type") == "purchase"),
            cents=F.sum((money("value") * 100).cast("long")),
            first_at=F.min(F.unix_micros("ts")),
            last_at=F.max(F.unix_micros("ts")),
        )
        reports = drain(append_to_files(stream, f"{area}/rows", f"{area}/checkpoint", interval="1 second"))
        append_progress(spark, reports, PROGRESS, f"{area}/progress/part={part}")
    batches = spark.read.schema(f"batch long, rows long, {PROGRESS}, part int").parquet(f"{area}/progress")
    sums = [F.sum(c).alias(c) for c in ("rows", "seen", "purchases", "cents")]
    span = [F.timestamp_micros(F.min("first_at")).alias("first_at"), F.timestamp_micros(F.max("last_at")).alias("last_at")]
    return batches.groupBy("part").agg(*sums, *span)


@query(
    "T8 T9 T10 K9",
    "SELECT count(*) AS rows, count(DISTINCT event_id) AS ids, count(*) = count(DISTINCT event_id) AS exactly_once FROM events",
)
def stream_exactly_once(spark, sf_dir):
    """Sales appended to a table, half of the files at first, all in a second run on one checkpoint."""
    target, _ = _sales_table(spark, sf_dir)
    return repeated_ids(spark.table(target), "event_id")


@query(
    "T7 D15",
    "SELECT strftime(ts, '%Y-%m-%d-%H') AS hour, count(*) AS rows, round(sum(value), 2) AS total FROM events GROUP BY 1",
)
def stream_hourly(spark, sf_dir):
    """The same table by its hourly partitions."""
    target, _ = _sales_table(spark, sf_dir)
    by_hour = spark.table(target).groupBy("hour")
    return by_hour.agg(F.count("*").alias("rows"), F.round(F.sum("total"), 2).alias("total"))


def _sales_table(spark, sf_dir):
    """A stream of sales into a table partitioned by hour, in two runs; the second gets new rows."""
    placed = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.lit("order_placed").alias("event_type"),
        F.date_format("ts", MICROS).alias("timestamp"),
        F.concat(F.lit("O"), F.col("event_id").cast("string")).alias("order_id"),
        F.col("value").alias("total"),
    )
    half = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    folder = _topic(spark, placed.where(half), "order_id", placed.columns, "timestamp")
    target, checkpoint = f"{_schema(spark)}.sales", work_area(spark, "checkpoint")

    def run():
        sales = bronze.sales(folder_stream(spark, folder, files_per_batch=FILES_PER_BATCH))
        # few files an hour, and a crowded hour is split over several tasks
        sales = sales.withColumns(by_hour("event_timestamp")).hint("rebalance", "hour")
        return finish(append_to_table(sales, target, checkpoint, partition_by=["hour"]))

    first = run()
    _topic(spark, placed.where(~half), "order_id", placed.columns, "timestamp", folder)
    return target, (first, run())


@query(
    "T11 S15 K9",
    f"""WITH {EVENTS_CTE} SELECT event_type, count(*) AS events, count(DISTINCT order_id) AS orders
        FROM bronze WHERE order_id IS NOT NULL GROUP BY event_type""",
)
def stream_chain(spark, sf_dir):
    """Two streaming tables, the second following the first."""
    schema = _schema(spark)
    first, second = f"{schema}.events", f"{schema}.events_with_order"
    events = bronze.order_events(_order_stream(spark, sf_dir))
    finish(append_to_table(events, first, work_area(spark, "checkpoint")))
    following = bronze.with_orders(table_stream(spark, first))
    finish(append_to_table(following, second, work_area(spark, "checkpoint")))
    return (
        spark.table(second)
        .groupBy("event_type")
        .agg(F.count("processed_at").alias("events"), F.countDistinct("order_id").alias("orders"))
    )


@query("K10 T8", "SELECT event_id, value FROM events")
def stream_to_parquet(spark, sf_dir):
    """Rows through a parquet sink, everything available taken once."""
    rows = _given_events(spark, sf_dir).select("event_id", "value")
    return _written(spark, rows, "stream-parquet")


@query(
    "A16 K9",
    """SELECT event_type, count(*) AS events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100.0::DOUBLE AS total
       FROM events WHERE event_type = 'purchase' GROUP BY event_type""",
)
def stream_purchase_total(spark, sf_dir):
    """Messages of three fields to a table, then the purchases summed."""
    shaped = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("value").alias("amount"),
        F.date_format("ts", MICROS).alias("ts"),
    )
    stream = folder_stream(spark, _topic(spark, shaped, "event_id", shaped.columns, "ts"), files_per_batch=FILES_PER_BATCH)
    parsed = unpack(stream, value_text(), "event_id string, event_type string, amount decimal(10,2)")
    target = f"{_schema(spark)}.purchases"
    stamped = parsed.withColumn("processed_at", F.current_timestamp())
    finish(append_to_table(stamped, target, work_area(spark, "checkpoint")))
    totals = spark.sql(
        f"""SELECT event_type, count(*) AS events, sum(amount) AS total FROM {target}
            WHERE event_type = 'purchase' GROUP BY event_type"""
    )
    return doubles(totals, "total")
