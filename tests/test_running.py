"""Running values against brute force, with one key holding a third of all rows."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.operators.running import _running_in_parts, behind_running_max, cut, running_orders, split_hot


def hot_orders(seed: int, n: int):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n), n)
    return [
        (
            i,
            rng.choice([7, 7, None, 1, 2, 3]),
            None if rng.random() < 0.05 else date(2024, 1, 1) + timedelta(days=rng.choice([0, 0, 1, 5, 9])),
            rng.randrange(1, 500),
        )
        for i in ids
    ]


def expected_running(rows):
    """Total up to the end of the day, and place by day and id; NULL sorts first."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    out = {}
    for members in groups.values():
        ordered = sorted(members, key=lambda r: (r[2] is not None, r[2] or date.min, r[0]))
        for place, r in enumerate(ordered, 1):
            total = sum(m[3] for m in ordered if (m[2] or date.min) <= (r[2] or date.min))
            out[r[0]] = (total, place)
    return out


@pytest.mark.parametrize("width", [1, 50, 1_000_000])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_running_orders(spark, conf, width, broadcast):
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast)
    rows = hot_orders(width, 600)
    df = spark.createDataFrame(rows, "id long, customer int, day date, amount long")
    got = running_orders(df, "customer", "day", "id", "amount", width)
    assert set(got.columns) == {"id", "customer", "day", "amount", "running_total", "order_rank"}
    assert {r.id: (r.running_total, r.order_rank) for r in got.collect()} == expected_running(rows)


def expected_late(rows):
    newest, late = {}, {}
    for arrival, key, moment in sorted(rows, key=lambda r: r[0]):
        before = newest.get(key)
        if before is not None and moment is not None and moment < before:
            late[arrival] = before
        if moment is not None and (before is None or moment > before):
            newest[key] = moment
    return late


@pytest.mark.parametrize("width", [1, 7, 1_000_000])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_behind_running_max(spark, conf, width, broadcast):
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast)
    rng = random.Random(width)
    begin = datetime(2024, 1, 1)
    rows = [
        (
            a,
            rng.choice(["hot", "hot", None, "x"]),
            None if rng.random() < 0.05 else begin + timedelta(seconds=a + rng.randrange(-40, 40)),
        )
        for a in rng.sample(range(5000), 500)
    ]
    df = spark.createDataFrame(rows, "arrival long, place string, moment timestamp")
    got = behind_running_max(df, "place", "arrival", "moment", width)
    assert {r.arrival: r.latest_before for r in got.collect()} == expected_late(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from([None, 1, 2]), st.integers(0, 3), st.integers(-9, 9)), min_size=1, max_size=25
    ),
    st.integers(1, 6),
)
def test_running_orders_on_any_rows(spark, cells, width):
    rows = [(i, k, date(2024, 1, 1 + d), a) for i, (k, d, a) in enumerate(cells)]
    df = spark.createDataFrame(rows, "id long, customer int, day date, amount long").coalesce(1)
    got = running_orders(df, "customer", "day", "id", "amount", width)
    assert {r.id: (r.running_total, r.order_rank) for r in got.collect()} == expected_running(rows)


def test_split_hot_parts_the_rows(spark):
    df = spark.createDataFrame([(i, [None, None, 1, 1, 1, 2][i % 6]) for i in range(60)], "id long, k int")
    for limit, wanted in ((9, {None, 1, 2}), (10, {None, 1}), (20, {1})):
        cold, hot = split_hot(df, "k", limit)
        assert {r.k for r in hot.collect()} == wanted
        assert cold.count() + hot.count() == 60 and cold.columns == df.columns
    assert split_hot(df, "k", 30) == (df, None)


@pytest.mark.parametrize("spacing", [1, 1_000_003, 2**40 + 7])
def test_parts_are_even_whatever_the_positions(spark, conf, spacing):
    """One hot key: every window of every level is far smaller than the key."""
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(20_000).selectExpr(f"id * {spacing} AS id", "7 AS k", "date_add(DATE'2024-01-01', cast(id % 5 as int)) AS day", "1 AS amount")
    for order in (("k", "id"), ("k", "day", "id")):
        parts = cut(df, *order)
        sizes = [r["count"] for r in parts.groupBy("part", "k").count().collect()]
        assert sum(sizes) == 20_000 and len(sizes) <= 16 and max(sizes) < 4_000
    got = running_orders(df, "k", "day", "id", "amount", width=1_000)
    assert got.agg(F.max("order_rank"), F.countDistinct("order_rank"), F.max("running_total")).first() == (20_000, 20_000, 20_000)


def test_no_window_spans_a_hot_key(spark, conf, plan_text):
    """Row-level windows are by part and key; the only one by key is over the parts' sums."""
    df = spark.createDataFrame(hot_orders(1, 600), "id long, customer int, day date, amount long")
    _, hot = split_hot(df, "customer", 50)
    plan = plan_text(_running_in_parts(cut(hot, "customer", "day", "id"), "customer", "day", "id", "amount"))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    by_key = [line for line in windows if "windowspecdefinition(customer" in line]
    assert len(windows) > len(by_key) > 0 and all("part#" in line and "row_number" not in line for line in by_key)


def test_without_hot_keys_the_rows_are_shuffled_once(spark, plan_text):
    df = spark.createDataFrame(hot_orders(1, 300), "id long, customer int, day date, amount long")
    plan = plan_text(running_orders(df, "customer", "day", "id", "amount"))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
