from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.operators import changes
from orderloom.operators.rows import drop_where, set_where
from orderloom.plans import layers_sql
from orderloom.session import work_area
from orderloom.tables import ddl, maintenance, native


@pytest.fixture
def schema(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    ddl.create_schema(spark, name, work_area(spark, "schema"))
    yield name
    ddl.drop_schema(spark, name)


# --- catalog tables --------------------------------------------------------------


def test_create_insert_describe_drop(spark, schema):
    name = f"{schema}.shelves"
    ddl.create_table(spark, name, "aisle int, label string, filled_on date")
    ddl.insert_values(spark, name, "(4, 'tea', DATE'2023-05-01'), (9, 'rice', NULL)")
    assert spark.table(name).count() == 2
    assert [r.col_name for r in ddl.describe(spark, name).collect()] == ["aisle", "label", "filled_on"]
    assert ddl.table_type(spark, name) == "MANAGED"
    assert ddl.location(spark, name).endswith("/shelves")
    spark.range(1).createOrReplaceTempView("gone")
    assert [r.tableName for r in ddl.tables(spark, schema).collect()] == ["shelves"]
    assert {r.tableName for r in ddl.missing_tables(spark, schema, ["shelves", "gone"]).collect()} == {"gone"}
    ddl.drop_table(spark, name)
    assert ddl.tables(spark, schema).count() == 0
    assert schema in {r[0] for r in ddl.schemas(spark).collect()}


def test_partitioned_table_and_added_column(spark, schema):
    name = f"{schema}.jars"
    ddl.create_table(spark, name, "weight int, lid string, shelf string", partitioned_by="shelf")
    rows = spark.createDataFrame([("low", "tin", 250), ("high", "cork", 90)], "shelf string, lid string, weight int")
    ddl.append(rows, name)  # by name, whatever the order
    ddl.add_column(spark, name, "opened", "boolean")
    ddl.append(spark.createDataFrame([(310, "low", True, None)], "weight int, shelf string, opened boolean, lid string"), name)
    got = {r.weight: (r.lid, r.shelf, r.opened) for r in spark.table(name).collect()}
    assert got == {250: ("tin", "low", None), 90: ("cork", "high", None), 310: (None, "low", True)}
    counts = maintenance.partition_statistics(spark.table(name), "shelf")
    assert {tuple(r) for r in counts.collect()} == {("low", 2), ("high", 1)}


def test_day_partitions_prune(spark, schema, plan_text):
    name = f"{schema}.days"
    rows = spark.sql("SELECT id, timestampadd(HOUR, cast(id as int), TIMESTAMP'2024-01-01') AS ts FROM range(96)")
    ddl.write_partitioned(rows, name, ddl.by_day("ts"))
    one = spark.table(name).where(F.col("day") == F.lit(date(2024, 1, 3)))
    assert one.count() == 24
    plan = plan_text(one)
    assert "PartitionFilters: [isnotnull(day" in plan
    assert ddl.storage_matches(spark, name).first().matches


def test_replace_and_copy(spark, schema):
    ddl.replace(spark.range(5), f"{schema}.a")
    ddl.replace(spark.range(3), f"{schema}.a")
    assert ddl.copy_table(spark, f"{schema}.a", f"{schema}.b").count() == 3


def test_mini_medallion_in_sql(spark, schema):
    """Three orders, one of unreadable amount, among raw events of two kinds."""
    raw, silver, gold = (f"{schema}.{n}" for n in ("raw", "silver", "gold"))
    ddl.create_table(spark, raw, "event_id string, event_type string, raw_data string")
    ddl.insert_values(
        spark, raw,
        """('r7', 'order', '{"order_id": "k70", "amount": 12.25}'), ('r8', 'visit', '{"shop": "mill lane"}'),
           ('r9', 'order', '{"order_id": "k71", "amount": "a lot"}'), ('r10', 'order', '{"amount": 7.5, "order_id": "k72"}')""",
    )
    ddl.create_table(spark, silver, "order_id string, amount double, processed_at timestamp")
    ddl.create_table(spark, gold, "total_orders bigint, total_amount double, avg_amount double, computed_at timestamp")
    layers_sql.insert_orders_from_raw(spark, raw, silver)
    layers_sql.insert_order_totals(spark, silver, gold)
    row = spark.table(gold).first()
    assert (row.total_orders, row.total_amount, row.avg_amount) == (3, 19.75, 9.875)


def test_customer_summary_over_decimals(spark, schema):
    rows = [("k1", "ida", Decimal("3.10"), "2023-11-02"), ("k2", "bo", Decimal("20.00"), "2023-11-05"),
            ("k3", "ida", Decimal("0.95"), "2023-10-30"), ("k4", "ida", Decimal("4.00"), "2023-11-02")]
    orders = spark.createDataFrame(rows, "order_id string, customer_id string, total decimal(10,2), order_date string")
    ddl.replace(orders.withColumn("order_date", F.to_date("order_date")), f"{schema}.orders")
    got = layers_sql.customer_summary(spark, f"{schema}.orders", f"{schema}.summary")
    assert dict(got.dtypes)["total_spent"] == "decimal(20,2)"
    assert dict(got.dtypes)["avg_order_value"] == "decimal(14,6)"
    ida = {r.customer_id: r for r in got.collect()}["ida"]
    assert (ida.total_orders, ida.total_spent, ida.first_order, ida.last_order) == (
        3, Decimal("8.05"), date(2023, 10, 30), date(2023, 11, 2),
    )


def test_purchase_sum_of_a_message_table(spark, schema):
    rows = [("m1", "purchase", 5.5), ("m2", "return", 2.25), ("m3", "purchase", None), ("m4", "purchase", 31.0)]
    ddl.replace(spark.createDataFrame(rows, "event_id string, event_type string, amount double"), f"{schema}.e")
    total = spark.sql(f"SELECT sum(amount) FROM {schema}.e WHERE event_type = 'purchase'").first()[0]
    assert total == pytest.approx(36.5)


def test_rows_from_dicts(spark):
    inferred = spark.createDataFrame([{"event_id": "e1", "quantity": 2, "unit_price": 9.99}])
    assert dict(inferred.dtypes) == {"event_id": "string", "quantity": "bigint", "unit_price": "double"}


# --- change log -----------------------------------------------------------------------


MARCH = [datetime(2024, 3, d) for d in range(1, 9)]


def log_of(spark):
    """Three keys: kept, changed, and gone from the third version on."""
    rows = lambda *r: spark.createDataFrame(list(r), "id long, name string")
    return (
        changes.change(rows((1, "ash"), (2, "elm"), (3, "fir")), 1, "insert", MARCH[0])
        .unionByName(changes.change(rows((2, "oak"), (4, None)), 2, "update", MARCH[1]))
        .unionByName(changes.change(rows((3, "fir")), 3, "delete", MARCH[2]))
        .unionByName(changes.change(rows((3, "yew")), 4, "insert", MARCH[3]))
    )


STATES = {
    1: {(1, "ash"), (2, "elm"), (3, "fir")}, 2: {(1, "ash"), (2, "oak"), (3, "fir"), (4, None)},
    3: {(1, "ash"), (2, "oak"), (4, None)}, 4: {(1, "ash"), (2, "oak"), (3, "yew"), (4, None)},
}


def test_state_as_of_a_version_and_a_time(spark):
    log = log_of(spark)
    for version, rows in STATES.items():
        assert {tuple(r) for r in changes.as_of_version(log, ["id"], version).collect()} == rows
        moment = datetime(2024, 3, version, 12)
        assert {tuple(r) for r in changes.as_of_time(log, ["id"], moment).collect()} == rows
    assert changes.as_of_version(log, ["id"], 0).collect() == []
    assert [(r.version, r.operation, r.rows_changed) for r in changes.history(log).collect()] == [
        (1, "insert", 3), (2, "update", 2), (3, "delete", 1), (4, "insert", 1),
    ]


def test_two_changes_of_a_key_in_one_version(spark):
    """The later place wins, whatever the order of rows; equal places are decided the same way each time."""
    rows = lambda *r: spark.createDataFrame(list(r), "id long, name string")
    placed = rows((1, "ash"), (2, "elm"), (3, "fir"))
    log = (
        changes.change(placed, 1, "insert", MARCH[0])
        .unionByName(changes.change(rows((1, "box"), (2, "box")), 2, "update", MARCH[1], 2))
        .unionByName(changes.change(rows((1, "oak"), (2, "elm")), 2, "delete", MARCH[1], F.when(F.col("id") == 1, 1).otherwise(3)))
        .unionByName(changes.change(rows((3, "yew"), (3, "may")), 2, "update", MARCH[1], 7))
        .unionByName(changes.change(rows((None, "nut")), 2, "insert", MARCH[1]))
    )
    for some in (log, log.orderBy(F.desc("place")), log.repartition(7)):
        assert {tuple(r) for r in changes.as_of_version(some, ["id"], 2).collect()} == {(1, "box"), (3, "yew"), (None, "nut")}


def test_early_versions_prune(spark, plan_text):
    """A stored log: a reader of an early state, by version or by time, reads the early folders only."""
    folder = work_area(spark, "changes")
    log = log_of(spark)
    changes.append_changes(log, folder)
    stored = changes.stored_changes(spark, folder, log.schema)
    assert stored.dtypes == log.dtypes and sorted(map(str, stored.collect())) == sorted(map(str, log.collect()))
    for version, rows in STATES.items():
        early = changes.as_of_version(stored, ["id"], version)
        assert {tuple(r) for r in early.collect()} == rows
        assert f"(version#" in plan_text(early) and "PartitionFilters: [isnotnull(version" in plan_text(early)
        timed = changes.as_of_time(stored, ["id"], datetime(2024, 3, version, 12))
        assert {tuple(r) for r in timed.collect()} == rows and "PartitionFilters: [isnotnull(committed_at" in plan_text(timed)
    read = [stored, stored.where("version <= 2")]
    plans = [df._jdf.queryExecution().executedPlan() for df in read]
    assert [len(p.executeCollect()) for p in plans] == [7, 5]
    assert [p.collectLeaves().head().metrics().apply("numFiles").value() for p in plans] == [4, 2]


def test_only_repeated_keys_are_sorted(spark, plan_text):
    """Rows of keys that come once go by an anti join; the aggregate that sorts sees the others."""
    plan = plan_text(changes.state(log_of(spark), ["id"]))
    assert "LeftAnti" in plan and "LeftSemi" in plan and plan.count("max_by") == 2  # its two halves, on the repeated


@pytest.mark.parametrize(("days", "last"), [(7, 5), (3, 2), (3, 6), (0, 1), (0, 8), (0, 50), (100, 1), (5, 2), (0, 0)])
def test_retention_keeps_by_age_and_by_number(spark, days, last):
    """Eight daily versions seen at noon of the last day: those go that are too old and not among the newest."""
    row = spark.createDataFrame([(1, "x")], "id long, name string")
    log = changes.change(row, 1, "insert", MARCH[0])
    for version in range(2, 9):
        log = log.unionByName(changes.change(row.withColumn("name", F.lit(f"v{version}")), version, "update", MARCH[version - 1]))
    now = datetime(2024, 3, 8, 12)
    gone = [v for v in range(1, 9) if MARCH[v - 1] < now - timedelta(days=days) and v <= 8 - last] if last else []
    first = max(gone) + 1 if gone else None
    assert changes.first_kept(log, now, days, last) == first
    kept = changes.expire(log, ["id"], now, days, last)
    assert sorted(r.version for r in kept.collect()) == list(range(first or 1, 9))
    assert changes.as_of_version(kept, ["id"], 8).first().name == "v8"


@pytest.mark.parametrize("version", [1, 2, 3, 4])
def test_squashing_keeps_later_states(spark, version):
    log = changes.squash(log_of(spark), ["id"], version)
    assert log.where(f"version <= {version}").groupBy("id").count().where("count > 1").count() == 0
    for later in range(version, 5):
        assert {tuple(r) for r in changes.as_of_version(log, ["id"], later).collect()} == STATES[later]


def test_update_and_delete_with_unknown_conditions(spark):
    readings = spark.createDataFrame([("north", 12.5), ("south", None), ("east", 140.0)], "place string, level double")
    raised = set_where(readings, {"level": F.col("level") + 1}, F.col("level") < 100)
    assert {tuple(r) for r in raised.collect()} == {("north", 13.5), ("south", None), ("east", 140.0)}
    assert {r.place for r in drop_where(readings, F.col("level") > 100).collect()} == {"north", "south"}


# --- maintenance --------------------------------------------------------------------


def test_compaction_respects_the_least_number_of_files(spark):
    folder, target = work_area(spark, "files"), work_area(spark, "compacted")
    spark.range(0, 1000, 1, 4).write.parquet(folder)
    left = maintenance.compact(spark, folder, target)
    assert (left.files_before, left.files_rewritten, left.files_after, left.target) == (4, 0, 4, None)
    assert maintenance.compacted(spark, left).count() == 1000
    done = maintenance.compact_on_demand(spark, folder, target, target_size_mb=1)
    assert (done.files_before, done.files_rewritten, done.files_after) == (4, 4, 1)
    assert sorted(r.id for r in maintenance.compacted(spark, done).collect()) == list(range(1000))


def test_compaction_aims_at_the_target_size(spark):
    folder, target = work_area(spark, "files"), work_area(spark, "compacted")
    spark.range(0, 200000, 1, 16).selectExpr("uuid() AS u").write.parquet(folder)
    size = maintenance.listing(spark, folder).agg(F.sum("length")).first()[0]
    done = maintenance.compact(spark, folder, target, target_bytes=size // 3 + 1)
    assert done.files_before == 16 and 2 <= done.files_after <= 4
    largest = maintenance.listing(spark, target).agg(F.max("length")).first()[0]
    assert largest < 1.6 * done.target_bytes
    assert maintenance.compacted(spark, done).count() == 200000


def test_compaction_below_the_split_size_still_makes_several_files(spark):
    folder, target = work_area(spark, "files"), work_area(spark, "compacted")
    spark.range(0, 300000, 1, 30).selectExpr("uuid() AS u").write.parquet(folder)
    done = maintenance.compact(spark, folder, target, target_bytes=1 << 20)
    assert 5 <= done.files_after < 30 and maintenance.compacted(spark, done).count() == 300000


def test_compaction_leaves_files_at_the_target_alone(spark):
    folder, target = work_area(spark, "files"), work_area(spark, "compacted")
    spark.range(0, 400000, 1, 2).selectExpr("uuid() AS u").write.parquet(folder)
    spark.range(0, 600, 1, 6).selectExpr("uuid() AS u").write.mode("append").parquet(folder)
    done = maintenance.compact(spark, folder, target, target_bytes=4 << 20)
    assert (done.files_before, done.files_rewritten, done.files_after) == (8, 6, 3)
    assert spark.read.parquet(target).count() == 600
    rows = maintenance.compacted(spark, done)
    assert rows.count() == 400600 and rows.distinct().count() == 400600


def test_compaction_keeps_partitions(spark, plan_text):
    folder, target = work_area(spark, "files"), work_area(spark, "compacted")
    spark.range(0, 900, 1, 6).selectExpr("id", "id % 3 AS p", "'x' AS q").write.partitionBy("p", "q").parquet(folder)
    assert maintenance.partition_columns(spark, folder) == ["p", "q"]
    done = maintenance.compact(spark, folder, target)
    assert (done.files_before, done.files_rewritten, done.files_after) == (18, 18, 3)
    one = maintenance.compacted(spark, done).where("p = 1")
    assert one.count() == 300 and "PartitionFilters: [isnotnull(p" in plan_text(one)


def test_compaction_below_a_folder_named_like_a_partition(spark):
    """The name above the table is no column of it; those below are."""
    folder, target = work_area(spark, "files") + "/day=1/e", work_area(spark, "compacted")
    spark.range(0, 600, 1, 6).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(folder)
    assert maintenance.partition_columns(spark, folder) == ["p"]
    done = maintenance.compact(spark, folder, target)
    assert (done.files_before, done.files_after) == (12, 2)
    got = maintenance.compacted(spark, done)
    assert got.columns == ["id", "p"] and sorted(map(tuple, got.collect())) == [(i, i % 2) for i in range(600)]
    plain, target = work_area(spark, "files") + "/day=1/e", work_area(spark, "compacted")
    spark.range(0, 60, 1, 6).write.parquet(plain)
    assert maintenance.partition_columns(spark, plain) == []
    assert maintenance.compact(spark, plain, target).files_after == 1


def test_bins_hold_a_share_of_a_folder(spark, plan_text):
    """A folder's list is cut by hash: no window spans more than a share, every file is in one bin, bins keep near the target."""
    rows = [(f"{place}/{i}.parquet", 10 + i % 7) for place, n in (("hot", 900), ("cold", 5)) for i in range(n)]
    files = spark.createDataFrame(rows, "path string, length long")
    for share in (50, 10_000):
        found = maintenance.bins(files, 100, share)
        got = {r.path: r.bin for r in found.collect()}
        assert sorted(got) == sorted(p for p, _ in rows)
        sizes, places = {}, {}
        for path, length in rows:
            sizes[got[path]] = sizes.get(got[path], 0) + length
            places.setdefault(got[path], set()).add(path.split("/")[0])
        assert max(sizes.values()) < 100 + 17 and all(len(p) == 1 for p in places.values())
        assert len(sizes) <= sum(sizes.values()) / 100 + 2 + 900 / share
    assert "windowspecdefinition(folder" in plan_text(found) and ", share" in plan_text(found)


def test_orphans_are_old_files_nobody_reads(spark):
    folder = work_area(spark, "files")
    spark.range(0, 10, 1, 3).write.parquet(f"{folder}/a")
    spark.range(0, 10, 1, 2).write.parquet(f"{folder}/b")
    live = spark.read.parquet(f"{folder}/b")
    found = maintenance.orphan_files(spark, folder, live, datetime(2100, 1, 1))
    assert found.count() == 3 and found.where("path LIKE '%/a/%' AND length > 0").count() == 3
    assert maintenance.orphan_files(spark, folder, live, datetime(2000, 1, 1)).count() == 0


def test_native_statements_parse(spark):
    """The catalogs that run them are not here; Spark's parser is."""
    moment = datetime(2024, 3, 1)
    parser = spark._jsparkSession.sessionState().sqlParser()
    for statement in (
        native.update("c.db.t", {"price": "14.99"}, "id = 'p1'"),
        native.delete("c.db.t", "level = 'ERROR'"),
        native.as_of_version("c.db.t", 7),
        native.as_of_time("c.db.t", moment),
        native.metadata("c.db.t", "snapshots"),
        native.compact("c", "db.t", maintenance.TARGET_BYTES, maintenance.NIGHTLY_MIN_FILES),
        native.expire("c", "db.t", moment, maintenance.KEEP_LAST),
        native.remove_orphans("c", "db.t", moment),
    ):
        parser.parsePlan(statement)
    assert native.update("t", {"a": "1", "b": "2"}, "c") == "UPDATE t SET a = 1, b = 2 WHERE c"
