"""Running values per key, without ever putting an unbounded key into one task.

A plain window sends every row of a key to one task. That is the cheapest plan
for a key of bounded size, so keys of up to `width` rows take it. The rows of hot
keys are cut by rank instead: a range shuffle on key and order deals them out in
parts of even size, whatever the values look like. The parts are summed up, a
window over the sums of a key, at most one per part, gives what lies before each,
and the row-level window runs inside one part.

Sums of doubles depend on the order of addition, so the two ways may differ in the
last digits; give decimals where equality matters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from orderloom.session import work_area

# The most rows of one key that a task sorts as a whole.
WIDTH = 1_000_000


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    folder = work_area(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def hot_keys(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Keys with more than `limit` rows, stored, so that the planner knows how many there are."""
    counts = df.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    return _stored(counts.where(F.col("n") > limit).select("hot_key"), "hot-keys")


def split_hot(df: DataFrame, key: str, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of keys with at most `limit` rows, and those of the others, if there are any.

    The list of hot keys has a known size: the session's threshold decides whether it
    is broadcast.
    """
    hot = hot_keys(df, key, limit)
    if hot.isEmpty():
        return df, None
    same = F.col(key).eqNullSafe(F.col("hot_key"))
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def cut(rows: DataFrame, *order: str) -> DataFrame:
    """Rows in parts of even size along an order; `part` counts them up.

    Stored, because a range shuffle that is run again may cut elsewhere.
    """
    dealt = rows.repartitionByRange(*order)
    return _stored(dealt.withColumn("part", F.spark_partition_id()), "parts")


def _until(*order: str, by: tuple[str, ...], last: int = -1) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, last)


def _with(left: DataFrame, right: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """Left rows with values of the right row of the same keys, NULL keys included."""
    right = right.select(*(F.col(k).alias(f"of_{k}") for k in keys), *values)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys))
    return left.join(right, same).select(*left.columns, *values)


def running_orders(
    orders: DataFrame,
    key: str,
    day: str,
    unique_id: str,
    amount: str,
    width: int = WIDTH,
) -> DataFrame:
    """Adds `running_total` and `order_rank` per key in order of day.

    Rows of the same day share the running total, as in the default RANGE frame.
    The rank is unique: ties of a day are numbered by `unique_id`.
    """
    cold, hot = split_hot(orders, key, width)
    by_key = Window.partitionBy(key)
    simple = cold.select(
        *orders.columns,
        F.row_number().over(by_key.orderBy(day, unique_id)).cast("long").alias("order_rank"),
        F.sum(amount).over(by_key.orderBy(day)).alias("running_total"),
    )
    if hot is None:
        return simple
    parts = _running_in_parts(cut(hot, key, day, unique_id), key, day, unique_id, amount)
    total = F.col("running_total").cast(simple.schema["running_total"].dataType)
    return simple.unionByName(parts.withColumn("running_total", total))


def _running_in_parts(parts: DataFrame, key: str, day: str, unique_id: str, amount: str) -> DataFrame:
    """The same for rows that are cut.

    The total of a day is that of its last row, wherever it lies.
    """
    sums = parts.groupBy("part", key).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("subtotal"))
    earlier = _until("part", by=(key,))
    before = sums.select(
        "part",
        key,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("subtotal").over(earlier).alias("total_before"),
    )
    inside = Window.partitionBy("part", key).orderBy(day, unique_id)
    so_far = F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = (
        _with(parts, before, ["part", key], "rows_before", "total_before")
        .withColumn("order_rank", F.row_number().over(inside) + F.col("rows_before"))
        .withColumn("so_far", so_far)
        .withColumn("so_far", F.coalesce(F.col("so_far") + F.col("total_before"), "so_far", "total_before"))
        .drop("part", "rows_before", "total_before")
    )
    days = rows.groupBy(key, day).agg(F.max_by(F.struct("so_far"), F.col("order_rank")).alias("last"))
    days = days.select(key, day, F.col("last.so_far").alias("running_total"))
    return _with(rows, days, [key, day], "running_total").drop("so_far")


def behind_running_max(
    events: DataFrame, key: str, arrival: str, moment: str, width: int = WIDTH
) -> DataFrame:
    """Events older than one that arrived before them under the same key.

    `arrival` is a unique position. Adds `latest_before`, the newest moment seen earlier.
    """
    cold, hot = split_hot(events, key, width)
    marked = cold.withColumn("latest_before", F.max(moment).over(_until(arrival, by=(key,))))
    if hot is not None:
        marked = marked.unionByName(_newest_in_parts(cut(hot, key, arrival), key, arrival, moment))
    return marked.where(F.col(moment) < F.col("latest_before"))


def _newest_in_parts(parts: DataFrame, key: str, arrival: str, moment: str) -> DataFrame:
    peaks = parts.groupBy("part", key).agg(F.max(moment).alias("peak"))
    before = peaks.select("part", key, F.max("peak").over(_until("part", by=(key,))).alias("peak_before"))
    inside = F.max(moment).over(_until(arrival, by=("part", key)))
    rows = _with(parts, before, ["part", key], "peak_before")
    return rows.withColumn("latest_before", F.greatest("peak_before", inside)).drop("part", "peak_before")
