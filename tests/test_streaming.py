from __future__ import annotations

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderloom.catalogue import fixture, registered, streams
from orderloom.functions.payload import as_message
from orderloom.functions.times import iso_timestamp, tolerant_timestamp
from orderloom.operators.quality import repeated_ids
from orderloom.session import work_area
from orderloom.sources.messages import append_messages, as_text, between, folder_batch, folder_stream, latest_position
from orderloom.sources.synthetic import click_events, rate_stream, sale_events
from orderloom.streaming import bronze, windows
from orderloom.streaming.runs import (
    append_progress,
    append_to_files,
    append_to_table,
    drain,
    finish,
    measured,
    open_state,
    progress,
    table_stream,
    to_console,
    watch,
)
from orderloom.tables.maintenance import partition_statistics

BEGIN = datetime(2024, 1, 1, 12)


def put(spark, folder, name, rows, schema):
    """One more file in a watched folder, named so that files arrive in order."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def files(folder):
    return f"{folder}/*"


def ticks(*seconds, kind="click"):
    return [(BEGIN + timedelta(seconds=s), kind) for s in seconds]


def test_order_messages_stream_like_they_batch(spark, events, tmp_path):
    columns = ["event_id", "event_type", "ts", "ts_seconds", "location_id", "order_id", "sequence", "body"]
    messages = as_message(events, F.col("order_id"), columns).withColumn("timestamp", F.current_timestamp())
    folder = str(tmp_path / "topic")
    messages.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "timestamp"
    ).repartition(5).write.parquet(folder)
    out = work_area(spark, "orders")
    query = append_to_files(
        bronze.order_events(folder_stream(spark, folder, files_per_batch=1)), f"{out}/rows", f"{out}/checkpoint"
    )
    reports = finish(query)
    assert len([r for r in reports if r["rows"]]) == 5 and sum(r["rows"] for r in reports) == 16
    streamed = spark.read.parquet(f"{out}/rows")
    batch = bronze.order_events(spark.read.parquet(folder))
    assert streamed.schema == batch.schema
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert streamed.where("event_timestamp = to_timestamp(ts)").count() == 16
    created = bronze.created_orders(spark.read.parquet(folder))
    assert created.count() == 8 and created.columns[-1] == "ts"
    assert as_text(spark.read.parquet(folder)).where("value LIKE '%order_created%'").count() == 8


def test_only_messages_that_can_name_the_type_are_parsed(spark, plan_text):
    named = '{"event_id": "%s", "event_type": "%s", "body": "%s"}'
    values = [
        named % ("a", "order_created", ""), named % ("b", "order\\u005fcreated", ""), named % ("c", "delivered", "order_created"),
        named % ("d", "delivered", ""), "order_created", "", None,
    ]
    created = bronze.created_orders(spark.createDataFrame([(None if v is None else v.encode(),) for v in values], "value binary"))
    assert [r.event_id for r in created.orderBy("event_id").collect()] == ["a", "b"]
    assert "Contains(" in plan_text(created)


@pytest.mark.parametrize("name", ["message_batch", "messages_between", "stream_purchase_total"])
def test_messages_are_made_once(spark, monkeypatch, sf_dir, name):
    """Rows are dealt by time before they become messages, not made twice, once for the cuts."""
    made, plain = spark.sparkContext.accumulator(0), streams._messages

    @F.udf("binary")
    def counted(value):
        made.add(1)
        return value

    monkeypatch.setattr(streams, "_messages", lambda *of: plain(*of).withColumn("value", counted("value")))
    registered()[name](spark, sf_dir).collect()
    log = fixture.event_log(spark, sf_dir) if name == "message_batch" else spark.read.parquet(f"{sf_dir}/events.parquet")
    assert made.value == log.count()


def test_late_rows_are_dropped_after_the_watermark(spark, tmp_path):
    """Windows of ten minutes, an hour of patience."""
    folder = str(tmp_path / "in")
    schema = "event_time timestamp, category string"
    out = work_area(spark, "late")

    def run():
        stream = windows.category_counts(folder_stream(spark, files(folder), schema))
        return sum(r["late_rows"] for r in finish(append_to_files(stream, f"{out}/rows", f"{out}/checkpoint")))

    put(spark, folder, "a", ticks(0, 30, 599, 600), schema)
    assert run() == 0
    put(spark, folder, "b", ticks(7200, 10), schema)  # within the hour before the watermark moves
    assert run() == 0
    put(spark, folder, "c", ticks(20, 7300), schema)  # the first window is closed by now
    assert run() == 1
    got = {(r.window_start, r.window_end): r["count"] for r in spark.read.parquet(f"{out}/rows").collect()}
    ten = timedelta(minutes=10)
    assert got == {(BEGIN, BEGIN + ten): 4, (BEGIN + ten, BEGIN + 2 * ten): 1}


def test_update_mode_ends_where_the_batch_does(spark, tmp_path):
    """Updates of a window, the last one kept, equal the batch result over all files."""
    folder = str(tmp_path / "in")
    schema = "timestamp timestamp, event_type string, event_value long"
    for n, name in enumerate("abc"):
        rows = [(BEGIN + timedelta(seconds=7 * i + n), "click" if i % 3 else "view", i) for i in range(20)]
        put(spark, folder, name, rows, schema)
    stream = windows.type_totals(folder_stream(spark, files(folder), schema, files_per_batch=1))
    query = (
        stream.writeStream.outputMode("update").format("memory").queryName("type_updates")
        .option("checkpointLocation", work_area(spark, "checkpoint")).trigger(availableNow=True).start()
    )
    finish(query)
    updates = spark.table("type_updates")
    last = updates.groupBy("window_start", "window_end", "event_type").agg(
        F.max("count").alias("count"), F.max("total_value").alias("total_value")
    )
    batch = windows.type_totals(spark.read.schema(schema).parquet(files(folder)))
    assert updates.count() > batch.count()
    assert sorted(last.collect()) == sorted(batch.collect())


@pytest.mark.parametrize("name", ["stream_type_totals", "stream_product_revenue", "stream_to_parquet"])
def test_no_row_is_lost_however_the_files_come(spark, conf, monkeypatch, sf_dir, tmp_path, name):
    """One file, a folder of files, and a file per batch with the newest first give the same rows."""
    given = spark.read.parquet(f"{sf_dir}/events.parquet").orderBy("ts").limit(600)
    plan = registered()[name]
    results = []
    for way in ("file", "folder", "falling"):
        root = tmp_path / way
        if way == "file":
            given.toPandas().to_parquet(tmp_path / "one.parquet", coerce_timestamps="us")
            root.mkdir()
            (tmp_path / "one.parquet").rename(root / "events.parquet")
        else:
            order = F.desc("ts") if way == "falling" else F.asc("event_id")
            given.repartitionByRange(4, order).write.parquet(f"{root}/events.parquet")
        monkeypatch.setattr(streams, "FILES_PER_BATCH", 1 if way == "falling" else 256)
        results.append(sorted(map(tuple, plan(spark, str(root)).collect())))
    assert results[0] and results[0] == results[1] == results[2]
    if name == "stream_type_totals":
        assert sum(r[3] for r in results[0]) == 600


@pytest.mark.parametrize("name", ["stream_type_counts", "stream_category_counts"])
def test_closed_windows_are_whole_however_the_files_come(spark, monkeypatch, sf_dir, tmp_path, name):
    """A file per batch, the newest first, gives the windows that one batch of all files gives, with all their rows."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").orderBy("ts").limit(600)
    results = []
    for way, order, per_batch in (("rising", F.asc("ts"), 256), ("falling", F.desc("ts"), 1)):
        root = tmp_path / way
        for k, part in enumerate(events.withColumn("part", F.ntile(4).over(Window.orderBy(order))).toPandas().groupby("part")):
            root.mkdir(exist_ok=True)
            (root / "events.parquet").mkdir(exist_ok=True)
            file = root / "events.parquet" / f"{k}.parquet"
            part[1].drop(columns="part").to_parquet(file, coerce_timestamps="us")
            os.utime(file, (1_700_000_000 + 10 * k,) * 2)  # the source takes files by age
        monkeypatch.setattr(streams, "FILES_PER_BATCH", per_batch)
        results.append(sorted(map(tuple, registered()[name](spark, str(root)).collect())))
    assert results[0] and results[0] == results[1]
    last = max(r[1] for r in results[0])
    assert sum(r[3] for r in results[0]) == events.where(F.col("ts") < F.lit(last)).count()


def test_state_stays_bounded_over_many_batches(spark, tmp_path):
    """Twelve hours, one a batch: closed windows come out and leave the state, which never holds more than the patience spans."""
    folder, out = str(tmp_path / "in"), work_area(spark, "bounded")
    schema = "ts timestamp, event_type string"
    left, removed = [], 0
    for hour in range(12):
        rows = [(BEGIN + timedelta(hours=hour, seconds=97 * i), kind) for i in range(37) for kind in ("click", "view")]
        put(spark, folder, f"h{hour:02d}", rows, schema)
        stream = windows.type_counts(folder_stream(spark, files(folder), schema, files_per_batch=1))
        reports = finish(append_to_files(stream, f"{out}/rows", f"{out}/checkpoint"))
        left.append(open_state(spark, f"{out}/checkpoint").count())
        removed += sum(r["state_removed"] for r in reports)
        assert reports[-1]["state_rows"] == left[-1] and sum(r["late_rows"] for r in reports) == 0
    # ten minutes of patience and the window of the newest row: three windows of two types at most
    assert max(left) <= 6 and len(set(left)) == 1
    closed = spark.read.parquet(f"{out}/rows")
    assert closed.count() == removed == 12 * 12 * 2 - left[-1]
    # what came out is what one batch over everything says of these windows
    whole = windows.type_counts(spark.read.schema(schema).parquet(files(folder)), late=None)
    assert closed.exceptAll(whole).count() == 0
    keys = open_state(spark, f"{out}/checkpoint").select("key.window.start", "key.window.end", "key.event_type", "value.count")
    assert whole.exceptAll(closed).exceptAll(keys).count() == 0


def test_state_lies_in_rocksdb(spark, tmp_path):
    folder, out = str(tmp_path / "in"), work_area(spark, "rocks")
    schema = "ts timestamp, event_type string"
    put(spark, folder, "a", ticks(0, 400), schema)
    query = append_to_files(windows.type_counts(folder_stream(spark, files(folder), schema)), f"{out}/rows", f"{out}/checkpoint")
    finish(query)
    assert any(k.startswith("rocksdb") for k in query.lastProgress["stateOperators"][0]["customMetrics"])


def message_rows(n, step=60):
    return [(f"k{i % 7}".encode(), f"v{i}".encode(), BEGIN + timedelta(seconds=step * i)) for i in range(n)]


def test_positions_of_a_batch(spark, conf, tmp_path):
    """From a position on, before another; None is the earliest or the latest; a crowded moment spans files."""
    conf("spark.sql.adaptive.enabled", "false")  # all shuffle partitions become files
    folder = str(tmp_path / "topic")
    rows = [*message_rows(400), *[(b"hot", str(i).encode(), BEGIN + timedelta(seconds=6000)) for i in range(4000)]]
    append_messages(spark.createDataFrame(rows, "key binary, value binary, timestamp timestamp").repartition(3), folder)
    at = lambda s: BEGIN + timedelta(seconds=s)
    read = lambda *span: folder_batch(spark, folder, *span)
    assert read().count() == 4400
    assert read(at(6000), at(6060)).count() == 4001 and read(at(6000), at(6000)).count() == 0
    assert read(None, at(6000)).count() == 100 and read(at(6001)).count() == 299
    assert read(at(0), at(1)).select("value").collect()[0].value == b"v0"
    assert latest_position(spark, folder) == at(399 * 60) + timedelta(microseconds=1)
    crowded = spark.read.parquet(folder).where("key = 'hot'").select("_metadata.file_path").distinct()
    assert crowded.count() > 1
    # files lie apart in time: each begins where another ends
    spans = sorted(map(tuple, spark.read.parquet(folder).groupBy("_metadata.file_path").agg(F.min("timestamp"), F.max("timestamp")).drop("file_path").collect()))
    assert len(spans) == 4 and all(a[1] <= b[0] for a, b in zip(spans[:-1], spans[1:], strict=True))


def test_a_range_reads_its_row_groups_only(spark, plan_text, tmp_path):
    folder = str(tmp_path / "topic")
    spark.range(200_000).selectExpr(
        "cast(string(id) AS binary) AS key", "cast(sha2(string(id), 512) AS binary) AS value", "timestamp_seconds(1700000000 + id) AS timestamp"
    ).sortWithinPartitions("timestamp").coalesce(1).sortWithinPartitions("timestamp").write.option("parquet.block.size", 1 << 20).parquet(folder)
    start = datetime(2023, 11, 15)
    part = folder_batch(spark, folder, start, start + timedelta(minutes=30))
    plan = plan_text(part)
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan
    plan = part._jdf.queryExecution().executedPlan()
    assert part.count() == 1800
    plan.executeCollect()
    read = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    assert 1800 <= read < 60_000  # of 200,000


def test_positions_of_a_stream(spark, tmp_path):
    """A reader from the latest position gets nothing that was there before it, one from the earliest all, also when started again."""
    folder = str(tmp_path / "topic")
    schema = "key binary, value binary, timestamp timestamp"
    rows = message_rows(90)
    append_messages(spark.createDataFrame(rows[:30], schema), folder)
    start = latest_position(spark, folder)
    seen = {}
    for name, position in (("earliest", None), ("latest", start)):
        out = work_area(spark, name)
        for k in range(1, 4):
            if name == "earliest" and k > 1:
                append_messages(spark.createDataFrame(rows[30 * (k - 1) : 30 * k], schema), folder)
            stream = between(folder_stream(spark, folder, files_per_batch=2), position)
            finish(append_to_files(stream, f"{out}/rows", f"{out}/checkpoint"))
            seen[name, k] = spark.read.schema(schema).parquet(f"{out}/rows").count()
    assert [seen["earliest", k] for k in (1, 2, 3)] == [30, 60, 90]
    assert seen["latest", 3] == 60
    empty = str(tmp_path / "empty")
    append_messages(spark.createDataFrame([], schema), empty)
    assert latest_position(spark, empty) is None


def test_files_that_are_gone(spark, tmp_path):
    """A file that vanishes between its listing and its batch is passed over, the others are not."""
    folder = tmp_path / "in"
    for n in range(3):
        put(spark, str(folder), f"f{n}", [(n, BEGIN)], "event_id long, ts timestamp")
        for file in (folder / f"f{n}").glob("*.parquet"):
            os.utime(file, (1_700_000_000 + 10 * n,) * 2)
    seen = []

    def take(rows, batch):
        seen.extend(r.event_id for r in rows.collect())
        for file in (folder / "f1").glob("*"):
            file.unlink()

    stream = folder_stream(spark, files(str(folder)), "event_id long, ts timestamp", files_per_batch=1)
    finish(stream.writeStream.foreachBatch(take).option("checkpointLocation", work_area(spark, "gone")).trigger(availableNow=True).start())
    assert seen == [0, 2]


def test_progress_carries_measures_and_is_kept(spark, tmp_path):
    """By the second, stopped, gone on: every row is in one report, and the reports make a table."""
    folder, out = str(tmp_path / "in"), work_area(spark, "measured")
    schema = "event_id long, ts timestamp"
    kept = f"{out}/progress"

    def run():
        stream = folder_stream(spark, files(folder), schema, files_per_batch=2)
        stream = measured(stream, "passed", seen=F.count(F.lit(1)), largest=F.max("event_id"))
        reports = drain(append_to_files(stream, f"{out}/rows", f"{out}/checkpoint", interval="200 milliseconds"))
        append_progress(spark, reports, "seen long, largest long", kept)
        return reports

    for n in range(5):
        put(spark, folder, f"f{n}", [(10 * n + i, BEGIN) for i in range(10)], schema)
    first = run()
    assert [r["rows"] for r in first if r["rows"]] == [20, 20, 10]
    put(spark, folder, "f5", [(90, BEGIN)], schema)
    assert [r["measures"] for r in run() if r["rows"]] == [{"seen": 1, "largest": 90}]
    table = spark.read.parquet(kept).where("rows > 0")
    assert [tuple(r) for r in table.orderBy("batch").select("batch", "rows", "seen", "largest").collect()] == [
        (0, 20, 20, 19), (1, 20, 20, 39), (2, 10, 10, 49), (3, 1, 1, 90),
    ]
    assert spark.read.parquet(f"{out}/rows").count() == 51


def test_a_crowded_hour_is_split(spark, sf_dir, plan_text):
    """The write of hourly partitions rebalances: AQE splits the partition of a hot hour."""
    stream = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("hour", F.date_format("ts", "yyyy-MM-dd-HH"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_text(stream.hint("rebalance", "hour"))


def test_finish_keeps_all_reports(spark, conf, tmp_path):
    conf("spark.sql.streaming.numRecentProgressUpdates", "2")
    folder, out = str(tmp_path / "in"), work_area(spark, "reports")
    spark.range(0, 60, 1, 6).write.parquet(folder)
    stream = folder_stream(spark, folder, "id long", files_per_batch=1)
    reports = finish(append_to_files(stream, f"{out}/rows", f"{out}/checkpoint"), every=0.02)
    assert sum(r["rows"] for r in reports) == 60 and len(reports) >= 6


def test_second_run_of_the_sales_table_gets_new_rows(spark, sf_dir):
    target, (first, second) = streams._sales_table(spark, sf_dir)
    rows = [sum(r["rows"] for r in run) for run in (first, second)]
    assert min(rows) > 0 and sum(rows) == spark.table(target).count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert [r.col_name for r in spark.sql(f"DESCRIBE {target}").collect()].count("hour") == 2  # a column, and the partition


def test_product_revenue_windows(spark, tmp_path):
    clicks = [
        {"event_id": i, "timestamp": f"2024-01-01T12:00:{s:02d}.000000", "user_id": "u", "event_type": "buy",
         "product": p, "price": 2.5, "quantity": q}
        for i, (s, p, q) in enumerate([(1, "pen", 2), (29, "pen", 1), (30, "pen", 4), (31, "ink", 1)])
    ]
    folder = str(tmp_path / "topic")
    rows = [(b"k", json.dumps(c).encode(), BEGIN) for c in clicks]
    put(spark, folder, "a", rows, "key binary, value binary, timestamp timestamp")
    result = windows.product_revenue(bronze.clicks(spark.read.parquet(files(folder))))
    got = sorted((r.window_start.second, r.product, r.event_count, r.total_revenue) for r in result.collect())
    assert got == [(0, "pen", 2, 7.5), (30, "ink", 1, 2.5), (30, "pen", 1, 10.0)]


def test_watermark_bounds_five_minute_counts(spark):
    rows = spark.createDataFrame(ticks(0, 299, 300), "ts timestamp, event_type string")
    assert sorted(r["count"] for r in windows.type_counts(rows).collect()) == [1, 2]


def test_restart_adds_only_what_is_new(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "event_id long, ts timestamp"
    name = f"restart_{tmp_path.name.replace('-', '_')}"
    checkpoint = work_area(spark, "checkpoint")

    def run():
        stream = folder_stream(spark, files(folder), schema).withColumn("hour", F.date_format("ts", "HH"))
        finish(append_to_table(stream, name, checkpoint, partition_by=["hour"]))
        return repeated_ids(spark.table(name), "event_id").first()

    put(spark, folder, "a", [(i, BEGIN + timedelta(minutes=i)) for i in range(90)], schema)
    assert run().asDict() == {"rows": 90, "ids": 90, "exactly_once": True}
    assert run().rows == 90
    put(spark, folder, "b", [(i, BEGIN) for i in range(90, 100)], schema)
    assert run().asDict() == {"rows": 100, "ids": 100, "exactly_once": True}
    assert {tuple(r) for r in partition_statistics(spark.table(name), "hour").collect()} == {("12", 70), ("13", 30)}


def test_a_query_stopped_between_files_goes_on(spark, tmp_path):
    """Stopped after some of its files, started again: every row once, none lost."""
    folder = str(tmp_path / "in")
    schema = "event_id long, ts timestamp"
    for n in range(12):
        put(spark, folder, f"f{n:02d}", [(100 * n + i, BEGIN) for i in range(50)], schema)
    out = work_area(spark, "stopped")

    def start(interval):
        stream = folder_stream(spark, files(folder), schema, files_per_batch=1)
        return append_to_files(stream, f"{out}/rows", f"{out}/checkpoint", interval=interval)

    first = watch(start("1 second"), seconds=4, every=0.2)
    assert 0 < sum(r["rows"] for r in first) < 600
    finish(start(None))
    stored = spark.read.schema(schema).parquet(f"{out}/rows")
    assert repeated_ids(stored, "event_id").first().asDict() == {"rows": 600, "ids": 600, "exactly_once": True}


def test_a_failed_batch_leaves_nothing_behind(spark, tmp_path):
    """A job that dies on one file repeats that batch only, once it can."""
    folder = str(tmp_path / "in")
    schema = "event_id long, ts string"
    put(spark, folder, "a", [(1, "2024-01-01T00:00:00")], schema)
    put(spark, folder, "b", [(2, "2024-01-01T00:00:01"), (3, "never")], schema)
    out = work_area(spark, "failed")
    raw = folder_stream(spark, files(folder), schema, files_per_batch=1)

    def start(parse):
        stream = raw.withColumn("event_timestamp", parse(F.col("ts")))
        return append_to_files(stream, f"{out}/rows", f"{out}/checkpoint")

    with pytest.raises(StreamingQueryException):
        finish(start(iso_timestamp))
    assert spark.read.parquet(f"{out}/rows").count() == 1
    finish(start(tolerant_timestamp))
    stored = spark.read.parquet(f"{out}/rows")
    assert {(r.event_id, r.event_timestamp is None) for r in stored.collect()} == {(1, False), (2, False), (3, True)}


def test_chained_tables_follow_each_other(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "order_id string, n int"
    first = f"chain_a_{tmp_path.name.replace('-', '_')}"
    second = f"chain_b_{tmp_path.name.replace('-', '_')}"
    marks = [work_area(spark, "checkpoint") for _ in range(2)]

    def run():
        finish(append_to_table(folder_stream(spark, files(folder), schema), first, marks[0]))
        finish(append_to_table(bronze.with_orders(table_stream(spark, first)), second, marks[1]))
        return spark.table(second)

    put(spark, folder, "a", [("x", 1), (None, 2)], schema)
    assert run().count() == 1
    put(spark, folder, "b", [("y", 3)], schema)
    result = run()
    assert {r.order_id for r in result.collect()} == {"x", "y"}
    assert result.where("processed_at IS NULL").count() == 0


def test_rate_source_bounded_run(spark):
    """Ten rows a second for some seconds, stopped by the watcher."""
    out = work_area(spark, "rate")
    sales = sale_events(rate_stream(spark, rows_per_second=10))
    query = append_to_files(sales, f"{out}/rows", f"{out}/checkpoint", interval="1 second")
    reports = watch(query, seconds=8, every=0.5)
    assert not query.isActive and sum(r["rows"] for r in reports) > 0
    stored = spark.read.schema(sales.schema).parquet(f"{out}/rows")
    assert stored.where("order_id NOT LIKE 'RATE-%' OR total <> unit_price * quantity").count() == 0
    assert repeated_ids(stored, "event_id").first().exactly_once
    assert progress(query) == reports


@pytest.mark.parametrize("mode", ["append", "update"])
def test_console_sink(spark, mode):
    stream = (
        spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 4)
        .option("numPartitions", 1).option("startTimestamp", 0).load()
    )
    rows = click_events(stream)
    shown = rows if mode == "append" else windows.type_totals(rows)
    query = to_console(shown, mode)
    reports = watch(query, seconds=4)
    assert query.exception() is None and sum(r["rows"] for r in reports) > 0
    assert query.lastProgress["sink"]["description"].startswith("org.apache.spark.sql.execution.streaming.ConsoleTable")


def test_partial_counts_before_the_shuffle(spark, plan_text):
    rows = spark.createDataFrame(ticks(0), "ts timestamp, event_type string")
    assert "partial_count" in plan_text(windows.type_counts(rows))
