"""Joins that stay correct and balanced whatever the sizes turn out to be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    facts: DataFrame, dim: DataFrame, on: str | list[str] | Column, how: str = "left"
) -> DataFrame:
    """Facts extended by a dimension.

    The session's thresholds decide, by the planner's estimate and again by the size at run
    time, whether the dimension is broadcast; beyond them AQE splits the partitions of a
    shuffle join that a hot key fills.
    """
    return facts.join(dim, on=on, how=how)


def shuffle_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Sort-merge join on purpose, for two large sides."""
    return left.join(right.hint("merge"), on=on, how=how)


def missing_keys(facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Non-NULL fact keys the dimension does not hold, each once.

    Distinct before the join, so a key shared by any number of facts travels once.
    """
    used = facts.select(F.col(fact_key)).where(F.col(fact_key).isNotNull()).distinct()
    known = dim.select(F.col(dim_key).alias(fact_key))
    return used.join(known, on=fact_key, how="left_anti")
