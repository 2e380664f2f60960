from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from orderloom.operators import quality
from orderloom.schemas import EVENT_TYPES
from orderloom.sources.files import with_event_time


def broken_forms(body: str) -> list[str]:
    """The ways a body gets corrupted: cut off, no brace, no quote, extra comma."""
    return [body[: len(body) // 2], body[:-1], body.replace('"', "", 1), body[:-1] + ",}"]


def readable(body: str) -> bool:
    try:
        json.loads(body)
    except ValueError:
        return False
    return True


def test_quarantine_against_a_json_parser(spark):
    whole = [
        '{"brand_id": 3, "total": 12.5}',
        '{"brand_id": "x", "items": [{"price": 1.5, "name": "a"}], "total": null}',
        '{"driver_id": "D1", "vehicle_type": "bike"}',
    ]
    bodies = whole + [b for w in whole for b in broken_forms(w)]
    rows = spark.createDataFrame(list(enumerate(bodies)) + [(99, None)], "id int, body string")
    good, bad = quality.quarantine(rows)
    assert {r.id for r in good.collect()} == {i for i, b in enumerate(bodies) if readable(b)} | {99}
    assert {r.id for r in bad.collect()} == {i for i, b in enumerate(bodies) if not readable(b)}
    assert good.columns == bad.columns == ["id", "body"]


ESCAPES = [
    "{} x", "{}} x", "{}]} x", '{}, "it": {}', '{}, "b": {}', '{}}, {"it": {}', '{}, "it": {}} x', "{},{}", "{}]", "[{}]", "[]", "null", "7", '"{"',
    '"{}"', "", " ", "{", "}", '{"a": 1', '{"a": 1}}', '{"a": {"b": [1, {"c": "}"}]}}', ' \t\r\n{"a": 1} \n', '{"a": 1}\x0b', "\ufeff{}", "{'a': 1}",
    '{a: 1}', '{"a": NaN}', '{"a": 01}', '{"a": 1,}', '{"a": "x\ny"}', '{"a": 1, "a": 2}', '{"": {}}', '{"a": 1} // no', '{"a": /* no */ 1}',
]


def test_nothing_in_a_text_passes_for_its_end(spark):
    """Texts that close the object around them, bring members of their own, or are other values."""
    rows = spark.createDataFrame(list(enumerate(ESCAPES)), "id int, body string")
    _, bad = quality.quarantine(rows)
    want = {i for i, b in enumerate(ESCAPES) if not (readable(b) and isinstance(json.loads(b), dict) and "NaN" not in b)}
    assert {r.id for r in bad.collect()} == want


def test_one_parse(spark, plan_text):
    rows = spark.createDataFrame([(1, "{}")], "id int, body string")
    plan = plan_text(quality.quarantine(rows)[0])
    assert plan.count("from_json") == 1 and "variant" not in plan and "parse_json" not in plan


def test_readable_is_one_object_and_nothing_else(spark):
    fine = ['{}', ' {"a": 1}\n', '{"a": {"b": [1, "x, y"]}, "c": null}', '{"a": "} x"}']
    broken = ["", " ", "null", "123", "[1]", '"text"', '{"a": 1} x', '{"a": 1}}', '{"a": 1}{"b": 2}', '{}, {}',
              '{}], [{}', '{}, "z": {}', "{'a': 1}", '{"a": 1', '{a: 1}']
    rows = spark.createDataFrame([(b,) for b in fine + broken], "body string")
    good, bad = quality.quarantine(rows)
    assert sorted(r.body for r in good.collect()) == sorted(fine)
    assert sorted(r.body for r in bad.collect()) == sorted(broken)


def test_bounds_on_the_mean(spark):
    df = spark.sql("SELECT * FROM VALUES (1.0D), (19.0D) AS t(value)")
    verdict = lambda *bound: quality.range_checks(df, {"value": (0, 20)}, means={"value": bound}).first().passed
    assert verdict(9, 11) and verdict(None, 10.5) and not verdict(10, 11) and not verdict(None, 10)


def test_null_ratios_of_some_rows(events):
    created = F.col("event_type") == "order_created"
    rows = quality.null_ratios(events, {"ts": 0.01, "body": 0.5}, only={"body": ~created}).collect()
    assert [r.null_ratio for r in rows] == [0, 0]
    late = quality.null_ratios(events, {"location_id": 0.5}, only={"location_id": F.col("event_id") == "B-1"}).first()
    assert late.null_ratio == 1 and not late.passed


def test_columns_present_and_filled(events):
    assert quality.missing_columns(events, ["event_id", "tip"]) == ["tip"]
    rows = {r.column_name: (r.filled, r.present) for r in quality.column_presence(events, ["event_id", "tip"]).collect()}
    assert rows == {"event_id": (15, True), "tip": (0, False)}
    complete = quality.column_presence(events, ["event_id", "ts"]).collect()
    assert all(r.present for r in complete)


def test_null_ratios(events):
    rows = {r.column_name: r for r in quality.null_ratios(events, {"order_id": 0.05, "ts": 0.01}).collect()}
    assert rows["order_id"].null_ratio == pytest.approx(1 / 16) and not rows["order_id"].passed
    assert rows["ts"].null_ratio == 0 and rows["ts"].passed
    assert quality.null_ratios(events.where("false"), {"ts": 0.01}).first().passed


def test_filter_effect_and_cardinalities(spark, events):
    effect = quality.filter_effect(events, F.col("order_id").isNotNull()).first()
    assert (effect.rows, effect.kept) == (16, 15)
    rows = quality.cardinalities({"a": (spark.range(4), 4), "b": (spark.range(5), 4)}).collect()
    assert [(r.table_name, r.actual, r.passed) for r in rows] == [("a", 4, True), ("b", 5, False)]


def test_range_checks_bounds(spark):
    df = spark.sql("SELECT * FROM VALUES (0, 5.0D), (23, 200.0D) AS t(hour, value)")
    rows = {r.column_name: r for r in quality.range_checks(df, {"hour": (0, 23), "value": (5, 200)}).collect()}
    assert rows["hour"].passed and rows["value"].passed and rows["value"].mean == 102.5
    strict = quality.range_checks(df, {"hour": (0, None), "value": (None, 200)}, ("hour", "value"))
    assert [r.passed for r in strict.collect()] == [False, False]
    assert quality.range_checks(df.where("false"), {"hour": (0, 23)}).first().passed


def test_ids_and_values(spark, events):
    ids = spark.createDataFrame([("a",), ("",), (None,)], "order_id string")
    assert quality.blank_ids(ids, "order_id").count() == 2
    assert quality.unknown_values(events, "event_type", list(EVENT_TYPES)).count() == 0
    few = quality.unknown_values(events, "event_type", ["order_created", "delivered", "driver_ping"])
    assert few.count() == len(EVENT_TYPES) - 3


def test_duplicates_and_exactly_once(events):
    assert {(r.event_id, r.copies) for r in quality.duplicates(events, "event_id").collect()} == {("A-0", 2)}
    assert not quality.repeated_ids(events, "event_id").first().exactly_once
    assert quality.repeated_ids(events.where("order_id = 'B'"), "event_id").first().exactly_once


def test_null_profile_counts_fields_and_body_keys(events):
    rows = {r.field: r.nulls for r in quality.null_profile(events, ["order_id"], ["brand_id", "lat"]).collect()}
    assert rows["order_id"] == 1 and rows["body_lat"] == 15
    bodies = [r.body for r in events.collect()]
    known = sum(1 for b in bodies if readable(b) and "brand_id" in json.loads(b))
    assert rows["body_brand_id"] == len(bodies) - known


def test_reconcile(spark):
    bronze = spark.createDataFrame([(1, 10.0), (2, 5.5)], "id int, total double")
    gold = spark.createDataFrame([("a", 15.5)], "k string, revenue double")
    fine = quality.reconcile(bronze, bronze, gold, "total", "revenue").first()
    assert fine.counts_match and fine.totals_match and fine.gold_total == 15.5
    lost = quality.reconcile(bronze, bronze.where("id = 1"), gold.where("false"), "total", "revenue").first()
    assert not lost.counts_match and not lost.totals_match


def test_profile(events):
    rows = {(r.section, r.item): r for r in quality.profile(with_event_time(events)).collect()}
    everything = rows["all", None]
    assert (everything.events, everything.orders) == (16, 7)  # NULL counts as one of the order ids
    assert rows["event_type", "order_created"].events == 8
    assert rows["location", "2"].events == 5 and ("location", None) not in rows


def test_checks_on_the_given_log(spark, sf_dir):
    """The property checks of a bronze and silver layer hold on the fixture log."""
    from orderloom.catalogue import fixture
    from orderloom.catalogue.medallion import enriched

    log = fixture.bronze(spark, sf_dir)
    assert quality.null_ratios(log, {"event_timestamp": 0.01}).first().passed
    events = enriched(spark, sf_dir)
    assert quality.range_checks(events, {"event_hour": (0, 23), "event_day_of_week": (1, 7)}).where("NOT passed").count() == 0
    copies = log.groupBy("event_id").count().where("count > 1").count()
    assert copies == quality.duplicates(log, "event_id").count() > 0
