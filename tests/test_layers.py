"""Silver and gold on a hand-made log, value by value."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderloom.operators import rows
from orderloom.operators.rows import one_per_key, since_day
from orderloom.plans import gold, sales, silver
from orderloom.sources.files import with_event_time


@pytest.fixture
def enriched(events, places):
    return silver.enrich(with_event_time(events), places)


def test_enrich_keeps_copies_and_drops_unusable_events(enriched):
    assert enriched.count() == 14
    assert enriched.where("event_id = 'A-0'").count() == 2
    assert enriched.where("order_id IS NULL OR event_id IS NULL").count() == 0


def test_enrich_fields(enriched):
    by_id = {r.event_id: r for r in enriched.collect()}
    assert by_id["A-0"].brand_id == 1 and by_id["A-0"].order_total == 10.5
    assert by_id["A-4"].driver_id == "D1"
    ping = by_id["A-6"]
    assert ping.latitude == 1.5 and ping.longitude is None  # the body says lon, the schema lng
    assert (by_id["A-0"].event_hour, by_id["A-0"].event_day_of_week, by_id["A-0"].is_weekend) == (10, 7, True)
    assert by_id["B-0"].is_weekend is False and by_id["B-0"].event_date == date(2024, 1, 8)
    assert by_id["B-1"].city_name is None and by_id["D-0"].city_name is None
    assert by_id["C-0"].brand_id is None and by_id["C-0"].order_total is None
    # one bad field leaves the others alone
    assert by_id["E-0"].brand_id == 2 and by_id["E-0"].order_total is None


def test_lifecycle_takes_first_times_and_splits_a_lost_location(enriched):
    rows = {(r.order_id, r.location_id): r for r in silver.lifecycle(enriched).collect()}
    assert set(rows) == {("A", 1), ("B", None)}
    a = rows["A", 1]
    assert a.created_at == datetime(2024, 1, 6, 10) and a.pickup_at == datetime(2024, 1, 6, 10, 16)
    assert (a.kitchen_duration_min, a.delivery_duration_min, a.total_duration_min) == (10.5, 15.0, 31.0)
    assert rows["B", None].created_at is None and rows["B", None].total_duration_min is None


def test_pivot_and_conditional_minimum_agree(enriched):
    one, other = silver.milestones(enriched), silver.milestones_by_pivot(enriched)
    assert one.columns == other.columns
    assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_milestones_shuffle_once(enriched, plan_text):
    plan = plan_text(silver.lifecycle(enriched))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min" in plan and "BroadcastHashJoin" in plan


def test_body_is_parsed_once_and_only_where_needed(enriched, plan_text):
    assert plan_text(enriched).count("from_json") == 1
    assert "from_json" not in plan_text(silver.lifecycle(enriched))


def test_narrow_chain_has_no_shuffle_and_prunes_its_scan(spark, sf_dir, plan_text):
    from orderloom.catalogue import registered

    plan = plan_text(registered()["narrow_chain"](spark, sf_dir))
    assert "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,50000.0)]" in plan
    assert "o_custkey" not in plan and "o_orderdate" not in plan


def test_top_k_keeps_k_rows_per_task(spark, sf_dir, plan_text):
    from orderloom.catalogue import registered

    assert "TakeOrderedAndProject" in plan_text(registered()["latest_events"](spark, sf_dir))


def test_hourly_counts_copies(enriched):
    rows = {(r.event_date, r.event_hour, r.location_id): r for r in gold.hourly_metrics(enriched).collect()}
    saturday = rows[date(2024, 1, 6), 10, 1]
    assert (saturday.order_count, saturday.total_revenue, saturday.unique_brands) == (2, 21.0, 1)
    monday = rows[date(2024, 1, 8), 11, 2]
    assert (monday.order_count, monday.total_revenue, monday.avg_order_value) == (3, 20.0, 20.0)
    unknown_place = rows[date(2024, 1, 8), 11, 9]
    assert unknown_place.city_name is None and unknown_place.unique_brands == 0


def test_brand_summary_keeps_the_unreadable_as_a_group(enriched, brands):
    rows = {r.brand_id: r for r in gold.brand_summary(enriched, brands).collect()}
    assert set(rows) == {1, 2, None}
    assert rows[None].brand_name is None and rows[None].total_orders == 2
    assert rows[2].total_orders == 2 and rows[2].brand_name == "Pies" and rows[2].locations_served == 1
    assert rows[1].first_order_date == rows[1].last_order_date == date(2024, 1, 6)


def test_brand_orders_by_path_reads_what_the_path_can(events, brands):
    rows = {r.brand_id: r.total_orders for r in gold.brand_orders_by_path(events, brands).collect()}
    assert rows[1] == 2


def test_delivery_performance_against_python(spark):
    durations = [float(d) for d in (5, 1, 9, 9, 30, 2, 7, 7, 7, 100)]
    rows = [("o%d" % i, 1, "Lyon", datetime(2024, 1, 6, 9), d, d / 2, d) for i, d in enumerate(durations)]
    orders = spark.createDataFrame(
        rows,
        "order_id string, location_id int, city_name string, created_at timestamp, "
        "kitchen_duration_min double, delivery_duration_min double, total_duration_min double",
    )
    got = gold.delivery_performance(orders).first()
    ranked = sorted(durations)
    assert got.completed_orders == 10 and got.avg_total_time_min == pytest.approx(17.7)
    assert got.median_total_time_min == ranked[4] and got.p95_total_time_min == ranked[9]
    city = gold.performance_by_city(gold.delivery_performance(orders)).first()
    assert (city.total_orders, city.avg_time_min, city.p95_time_min) == (10, 17.7, 100.0)


def test_since_day_and_one_per_key(events):
    assert since_day(events, 0).count() == 16
    assert {r.event_id for r in since_day(events, 2).collect()} >= {"B-0", "C-0", None}
    assert since_day(events, 2).where("order_id = 'A'").count() == 0
    kept = one_per_key(events.where("order_id = 'A'"), ["event_id"], ["ts_seconds"])
    assert kept.count() == 8 and kept.where("event_id = 'A-0'").first().ts == "2024-01-06T10:00:00"
    assert one_per_key(events, ["event_id"]).count() == 15


def test_rows_travel_once_to_their_first(spark, conf, monkeypatch, plan_text):
    """Too many repeated keys for a broadcast cost no second shuffle; a hot key is reduced before it travels."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    copies = spark.range(0, 3000, 1, 4).selectExpr(
        "IF(id % 3 = 0, NULL, IF(id % 3 = 1, 'hot', string(id div 6))) AS key", "IF(id % 7 = 0, NULL, id % 50) AS at", "id"
    )
    want = {}
    for r in copies.collect():
        rank = (r.at is not None, r.at or 0, r.id)  # NULL comes first
        want[r.key] = min(want.get(r.key, rank), rank)
    want = {(k, at if known else None, i) for k, (known, at, i) in want.items()}
    once = one_per_key(copies, ["key"], ["at", "id"])
    plan = plan_text(once)
    assert plan.count("Exchange") == 1 and "Join" not in plan
    got = [tuple(r) for r in once.collect()]
    assert set(got) == want and len(got) == len(want) == 502 and once.columns == copies.columns
    monkeypatch.setattr(rows, "HOT", 500)
    apart = one_per_key(copies, ["key"], ["at", "id"])
    assert plan_text(apart).count("Exchange") == 2  # the hot keys' own, after a partial aggregate
    assert sorted(map(str, apart.collect())) == sorted(map(str, once.collect()))


def test_sales_queries(spark):
    orders = spark.createDataFrame(
        [(1, "pen", 2.0, date(2024, 1, 1)), (1, "ink", 3.0, date(2024, 1, 2)), (2, "pen", 2.0, date(2024, 1, 2))],
        "customer int, product string, amount double, day date",
    )
    spent = {r.customer: r for r in sales.customer_spending(orders, "customer", "amount").collect()}
    assert (spent[1].order_count, spent[1].total_spent, spent[1].avg_order) == (2, 5.0, 2.5)
    assert [r.product for r in sales.product_revenue(orders, "product", "amount").collect()] == ["pen", "ink"]
    assert [r.daily_revenue for r in sales.daily_revenue(orders, "day", "amount").collect()] == [2.0, 5.0]
    taxed = sales.taxed(orders, "amount", 0.1, "taxed").agg(F.max("taxed")).first()[0]
    assert taxed == pytest.approx(3.3)
    extent = sales.value_range(orders, "amount").first()
    assert (extent.lowest, extent.highest) == (2.0, 3.0)
    assert [tuple(r) for r in sales.distribution(orders, "product").collect()] == [("pen", 2), ("ink", 1)]
