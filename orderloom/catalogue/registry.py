"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from orderloom.session import apply_engine_conf

REGISTRY: dict[str, Query] = {}


@dataclass(frozen=True)
class Query:
    name: str
    operators: tuple[str, ...]
    plan: Callable[[SparkSession, str], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return zoneless(self.plan(apply_engine_conf(spark), sf_dir))


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without zone, the way the given tables store them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned}) if zoned else df


def query(operators: str, sql: str | None = None, name: str | None = None):
    """Register a function under its own name; `operators` are SURVEY ids."""

    def register(plan):
        key = name or plan.__name__
        if key in REGISTRY and REGISTRY[key].plan.__module__ != plan.__module__:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(key, tuple(operators.split()), plan, sql)
        return plan

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mean_of_cents(amount: str, places: int = 6) -> str:
    """SQL for the exact mean of a two-decimal amount, rounded half up.

    Integer arithmetic, so it equals the mean of decimals bit for bit.
    """
    cents = f"CAST(sum(CAST(round(({amount}) * 100) AS BIGINT)) AS HUGEINT)"
    scale = 10 ** (places - 2)
    n = f"count({amount})"
    return f"(({cents} * {2 * scale} + {n}) // nullif(2 * {n}, 0)) / {10**places}.0::DOUBLE"


def sum_of_cents(amount: str) -> str:
    """SQL for the exact sum of a two-decimal amount."""
    return f"CAST(sum(CAST(round(({amount}) * 100) AS BIGINT)) AS BIGINT) / 100.0::DOUBLE"


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Exact decimal results as doubles, for comparison."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def money(column: str):
    """A two-decimal double as an exact decimal."""
    return F.col(column).cast("decimal(12,2)")
