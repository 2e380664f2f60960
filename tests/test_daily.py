"""The medallion by day, bucketed joins, mergeable percentiles, figures taken at the write."""

from __future__ import annotations

import uuid
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderloom.catalogue import registered
from orderloom.catalogue.tables import _bucketed_sales
from orderloom.operators import quality
from orderloom.plans import gold, silver
from orderloom.plans.daily import DAYS, DailyMedallion, on
from orderloom.plans.medallion import Sources
from orderloom.session import work_area
from orderloom.sources.files import with_event_time
from orderloom.tables import ddl

SCHEMA = "event_id string, event_type string, ts string, ts_seconds long, location_id int, order_id string, sequence int, body string"


def event(order, step, kind, ts, place=1, total=10.0):
    body = f'{{"brand_id": 1, "total": {total}}}' if kind == "order_created" else "{}"
    return (f"{order}-{step}", kind, ts, 0, place, order, step, body)


def order(name, *days, place=1):
    """Created and delivered at noon of two days."""
    first, last = days[0], days[-1]
    return [event(name, 0, "order_created", f"2024-03-{first:02d}T12:00:00", place), event(name, 7, "delivered", f"2024-03-{last:02d}T12:30:00", place)]


LOG = [*order("A", 1), *order("B", 1, 2), *order("C", 2, place=2), *order("D", 2, 3), *order("E", 3), *order("F", 4), event("G", 0, "order_created", "2024-03-02T15:00:00")]


@pytest.fixture
def build(spark):
    made = []

    def run(rows):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        log = with_event_time(spark.createDataFrame(rows, SCHEMA))
        dims = {
            "categories": spark.createDataFrame([(1, "soup")], "id int, name string"),
            "brands": spark.createDataFrame([(1, "inn")], "id int, name string"),
            "items": spark.createDataFrame([(1, 1, "broth", 3.0, 1)], "id int, brand_id int, name string, price double, category_id int"),
            "locations": spark.createDataFrame([(1, "here"), (2, "there")], "id int, city string"),
        }
        medallion = DailyMedallion(spark, f"day_{uuid.uuid4().hex[:8]}", work_area(spark, "daily"))
        counts = medallion.run(Sources(events=log, **dims))
        made.append(medallion)
        return medallion, {r.table_name: r.row_count for r in counts.collect()}

    yield run
    for medallion in made:
        for layer in ("bronze", "silver", "gold"):
            ddl.drop_schema(spark, f"{medallion.prefix}_{layer}")


def content(medallion):
    names = [("silver", "orders_enriched"), ("silver", "order_lifecycle"), ("gold", "hourly_metrics"), ("gold", "delivery_performance"), ("gold", "brand_summary")]
    return {t: sorted(map(str, medallion.read(layer, t).collect())) for layer, t in names}


def files(spark, medallion, layer, table):
    """Files by partition folder."""
    home = Path(ddl.location(spark, medallion.name(layer, table)).removeprefix("file:"))
    return {f"{p.parent.name}/{p.name}": p.stat().st_mtime_ns for p in home.rglob("*.parquet")}


def set_bronze(spark, medallion, rows):
    with_event_time(spark.createDataFrame(rows, SCHEMA)).write.mode("overwrite").insertInto(medallion.name("bronze", "orders"))


CHANGES = {
    "late events": (LOG, [*LOG, event("G", 7, "delivered", "2024-03-02T16:00:00"), *order("H", 2)], [2]),
    "a delivery comes later": (LOG, [r for r in LOG if r[0] != "B-7"] + [event("B", 7, "delivered", "2024-03-03T09:00:00")], [2, 3]),
    "a creation is lost": (LOG, [r for r in LOG if r[0] != "D-0"], [2]),
    "a day is lost": (LOG, [r for r in LOG if not r[2].startswith("2024-03-02")], [2]),
    "a new day": ([r for r in LOG if not r[2].startswith("2024-03-04")], LOG, [4]),
    "nothing": (LOG, LOG, [1, 2, 3, 4]),
    "another place": (LOG, [(*r[:4], 2, *r[5:]) if r[0] == "A-0" else r for r in LOG], [1]),
}


@pytest.mark.parametrize("name", sorted(CHANGES))
def test_a_rebuild_of_days_equals_a_full_build(spark, build, name):
    before, after, days = CHANGES[name]
    medallion, counts = build(before)
    assert counts["silver.orders_enriched"] == len(before)
    set_bronze(spark, medallion, after)
    days = [date(2024, 3, d) for d in days]
    wrote = medallion.rebuild(days, span=None if len(days) == 1 else 3)
    assert content(medallion) == content(build(after)[0])
    assert set(wrote["orders_enriched"]) <= set(days) and set(wrote["hourly_metrics"]) <= set(days)
    left = {r[0] for r in medallion.read("silver", "orders_enriched").select("event_date").distinct().collect()}
    assert left == {date.fromisoformat(r[2][:10]) for r in after}


def test_other_days_stay_as_they_lie(spark, build):
    medallion, _ = build(LOG)
    before = {t: files(spark, medallion, layer, t) for layer, t in (("silver", "orders_enriched"), ("gold", "hourly_metrics"))}
    set_bronze(spark, medallion, [*LOG, *order("H", 2)])
    wrote = medallion.rebuild([date(2024, 3, 2)])
    assert wrote["orders_enriched"] == wrote["hourly_metrics"] == [date(2024, 3, 2)]
    assert wrote["order_lifecycle"] == [date(2024, 3, 2), date(2024, 3, 3)]  # order D is delivered a day later
    for table, old in before.items():
        now = files(spark, medallion, "silver" if table == "orders_enriched" else "gold", table)
        day = "event_date=2024-03-02"
        assert {f: t for f, t in old.items() if day not in f} == {f: t for f, t in now.items() if day not in f}
        assert not {f for f in old if day in f} & {f for f in now if day in f}


def test_reads_of_a_day_prune(spark, build, plan_text):
    medallion, _ = build(LOG)
    for (layer, table), column in {("silver", "orders_enriched"): "event_date", ("gold", "hourly_metrics"): "event_date"}.items():
        assert DAYS[table] == column
        plan = plan_text(medallion.read(layer, table).where(on([date(2024, 3, 2)], column)))
        assert f"PartitionFilters: [isnotnull({column}" in plan
    hours = gold.hourly_metrics(medallion.read("silver", "orders_enriched").where(on([date(2024, 3, 2)], "event_date")))
    assert "PartitionFilters: [isnotnull(event_date" in plan_text(hours) and "EqualTo(event_type,order_created)" in plan_text(hours)


def test_days_that_are_not_known(spark):
    rows = spark.createDataFrame([(date(2024, 3, 1),), (None,), (date(2024, 3, 2),)], "d date")
    kept = lambda *days: {r.d for r in rows.where(on(list(days), "d")).collect()}
    assert kept(date(2024, 3, 1), None) == {date(2024, 3, 1), None}
    assert kept(None) == {None} and kept() == set() and kept(date(2024, 3, 2)) == {date(2024, 3, 2)}


def test_counts_come_from_the_writes(spark, build):
    """Row counts are those of the tables, and asking for them runs no job over them."""
    medallion, counts = build(LOG)
    assert len(counts) == 10
    assert counts == {n: medallion.read(*n.split(".")).count() for n in counts}
    plan = medallion.row_counts(["gold"])._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_layers_reconcile_by_their_writes(spark, sf_dir, plan_text):
    found = registered()["sales_reconciliation"](spark, sf_dir)
    assert "FileScan" not in plan_text(found)
    row = quality.reconcile_written(spark, {"rows": 3, "total": 5.0}, {"rows": 2, "total": 5}, {"total": 5.02, "rows": 1}).first()
    assert (row.counts_match, row.totals_match, row.silver_total) == (False, False, 5.0)
    empty = {"rows": 0, "total": None}
    row = quality.reconcile_written(spark, empty, empty, empty).first()
    assert (row.counts_match, row.totals_match, row.gold_total) == (True, False, None)


def test_bucketed_tables_join_without_a_shuffle(spark, conf, sf_dir, plan_text):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = _bucketed_sales(spark, sf_dir)
    plan = plan_text(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    assert joined.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    per_customer = plan_text(joined.groupBy("o_custkey").agg(F.sum("total")))
    assert per_customer.count("Exchange") == 1  # by customer, above the join


def test_merged_sketches_answer_for_all_orders(spark):
    """Percentiles over the orders of all days, not means of daily ones; within the stated share, merged in any grouping."""
    rows = spark.range(60_000).selectExpr(
        "timestampadd(HOUR, cast(id % 720 as int), TIMESTAMP'2024-03-01') AS created_at", "cast(id % 3 as int) AS location_id",
        "IF(id % 3 = 2, NULL, concat('c', id % 3)) AS city_name", "pow(cast(pmod(xxhash64(id), 100000) as double) / 1000, 2) AS total_duration_min",
    )
    size = 512
    sketches = gold.duration_sketches(rows, size)
    assert sketches.count() == 90
    bound = 2.4 / size**0.94
    for r in gold.durations_by_city(sketches, size).collect():
        own = rows.where(F.col("city_name").eqNullSafe(F.lit(r.city_name)))
        assert r.orders == own.count() == 20_000
        for answer, asked in ((r.median_time_min, 0.5), (r.p95_time_min, 0.95)):
            share = own.where(F.col("total_duration_min") <= answer).count() / r.orders
            assert abs(share - asked) < 2 * bound
    few = rows.limit(200)
    exact = few.groupBy("city_name").agg(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY total_duration_min)").alias("p"))
    got = {r.city_name: r.p95_time_min for r in gold.durations_by_city(gold.duration_sketches(few)).collect()}
    assert got == {r.city_name: r.p for r in exact.collect()}
    assert gold.durations_by_city(gold.duration_sketches(rows.limit(0))).collect() == []


def test_enriched_events_of_a_day_have_their_city(spark, build):
    medallion, _ = build(LOG)
    whole = silver.enrich(medallion.read("bronze", "orders"), medallion.read("bronze", "dim_locations"))
    assert whole.select(sorted(whole.columns)).exceptAll(medallion.read("silver", "orders_enriched").select(sorted(whole.columns))).count() == 0


