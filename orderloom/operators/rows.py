"""Row selection, deduplication, ranking, row-level changes."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return df.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns)))


def top(df: DataFrame, k: int, by: str, tie: str) -> DataFrame:
    """The k largest; the tie-break makes the choice repeatable."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


# Rows of one key that a task sorts; of a hotter key, every task keeps one before they travel.
HOT = 1_000_000


def one_per_key(df: DataFrame, keys: list[str], first_by: list[str] | None = None) -> DataFrame:
    """One row per key, NULL being a key: any of them, or the first in the given order.

    Any combine on the map side. With an order, rows are dealt by key and the first is taken
    where they lie: they travel once, however many keys are repeated, and nothing is sorted before.
    """
    if not first_by:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*first_by)).alias("__kept")

    def pick(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(first).select(*keys, "__kept.*").select(*df.columns)

    hot = hot_hashes(df, keys)
    if not hot:
        return pick(df.repartition(*keys))
    known = F.xxhash64(*keys).isin(hot)
    return pick(df.where(~known).repartition(*keys)).unionByName(pick(df.where(known)))


def hot_hashes(df: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the keys with more than `HOT` rows, from a sketch of all rows: no row travels.

    It tracks 10,000 keys, so a key that holds less than a two-thousandth of all rows may be missed.
    """
    top = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(10_000), F.lit(10_000))
    return [t["item"] for t in df.agg(top).first()[0] if t["count"] > HOT]


def pick_per_key(df: DataFrame, keys: list[str], pick: Callable[[Column], Column]) -> DataFrame:
    """One row per key, NULL being a key; `pick` is an aggregate that chooses among the rows of a repeated one."""
    names = {k: f"__{k}" for k in keys}
    repeated = df.groupBy(*(F.col(k).alias(n) for k, n in names.items())).agg(F.count("*").alias("__copies"))
    repeated = repeated.where("__copies > 1").drop("__copies")
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()))
    rest = [c for c in df.columns if c not in keys]
    several = df.join(repeated, same, "left_semi").groupBy(*keys).agg(pick(F.struct(*rest)).alias("__kept"))
    return df.join(repeated, same, "left_anti").unionByName(several.select(*keys, "__kept.*"))


def since_day(events: DataFrame, day: int) -> DataFrame:
    """Events from the given day of the log on; day 0 is where the log begins."""
    if day <= 0:
        return events
    begin = events.agg(F.min("ts_seconds")).scalar()
    return events.where(F.col("ts_seconds") >= begin + F.lit(day * 86400))


def set_where(df: DataFrame, changes: dict[str, Column], condition: Column) -> DataFrame:
    """UPDATE ... SET ... WHERE; a NULL condition leaves the row alone."""
    return df.withColumns(
        {name: F.when(condition, value).otherwise(F.col(name)) for name, value in changes.items()}
    )


def drop_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE ... WHERE; a NULL condition keeps the row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def add_columns(df: DataFrame, **types: str) -> DataFrame:
    """New columns, NULL in the rows that exist."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in types.items()})
