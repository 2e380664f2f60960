from __future__ import annotations

from orderloom.operators import joins


def tables(spark, n=200):
    facts = spark.range(n).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 5 > 0 THEN id END AS k")
    dim = spark.range(40).selectExpr("id AS k", "concat('n', id) AS name")
    return facts, dim


def test_lookup_broadcasts_only_below_the_limit(spark, conf, plan_text):
    facts, dim = tables(spark)
    assert "BroadcastHashJoin" in plan_text(joins.lookup(facts, dim, "k"))
    small = sorted(joins.lookup(facts, dim, "k").collect(), key=str)
    conf("spark.sql.autoBroadcastJoinThreshold", "16")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "16")
    large = joins.lookup(facts, dim, "k")
    assert "Broadcast" not in plan_text(large)
    assert sorted(large.collect(), key=str) == small
    assert len(small) == 200  # NULL and unknown keys are kept


def test_shuffle_join_is_sort_merge(spark, plan_text):
    facts, dim = tables(spark)
    joined = joins.shuffle_join(facts, dim, "k")
    assert "SortMergeJoin" in plan_text(joined)
    assert joined.count() == joins.lookup(facts, dim, "k", how="inner").count()


def test_hot_key_is_split_by_aqe(spark, conf):
    """One key holds a third of the rows; the join still gives every row once."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "2000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2000")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    facts = spark.range(0, 30000, 1, 8).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k")
    dim = spark.range(0, 30000, 1, 8).selectExpr("id AS k", "id * 2 AS twice")
    joined = joins.lookup(facts, dim, "k")
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where("twice = k * 2").count() == 30000


def test_missing_keys(spark):
    facts, dim = tables(spark, 60)
    got = {r.k for r in joins.missing_keys(facts, "k", dim, "k").collect()}
    used = {r.k for r in facts.collect() if r.k is not None}
    assert got == {k for k in used if k >= 40}
