"""Sales queries: customers, products, days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def customer_spending(orders: DataFrame, customer: str, amount: str) -> DataFrame:
    return orders.groupBy(customer).agg(
        F.count("*").alias("order_count"),
        F.sum(amount).alias("total_spent"),
        F.avg(amount).alias("avg_order"),
    )


def revenue_by(sales: DataFrame, key: str, amount: str, counted: str, revenue: str) -> DataFrame:
    return sales.groupBy(key).agg(F.count("*").alias(counted), F.sum(amount).alias(revenue))


def product_revenue(sales: DataFrame, product: str, amount: str) -> DataFrame:
    """Best sellers first."""
    totals = revenue_by(sales, product, amount, "times_ordered", "total_revenue")
    return totals.orderBy(F.desc("total_revenue"), product)


def daily_revenue(orders: DataFrame, day: str, amount: str) -> DataFrame:
    return revenue_by(orders, day, amount, "orders", "daily_revenue").orderBy(day)


def daily_sales(orders: DataFrame, created_at: str, amount: str) -> DataFrame:
    return orders.groupBy(F.date_trunc("day", created_at).alias("date")).agg(
        F.count("*").alias("order_count"),
        F.sum(amount).alias("revenue"),
        F.avg(amount).alias("avg_order_value"),
    )


def location_days(orders: DataFrame, day: str, location: str, order_id: str, amount: str) -> DataFrame:
    return orders.groupBy(day, location).agg(
        F.count(order_id).alias("order_count"), F.sum(amount).alias("revenue")
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Values and how often they occur, the most frequent first."""
    return df.groupBy(column).count().orderBy(F.desc("count"), column)


def totals(df: DataFrame, amount: Column | str) -> DataFrame:
    """One row: orders, sum and mean."""
    return df.agg(
        F.count("*").alias("total_orders"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("avg_amount"),
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.min(column).alias("lowest"), F.max(column).alias("highest"), F.avg(column).alias("mean")
    )


def taxed(df: DataFrame, amount: str, rate: float, name: str) -> DataFrame:
    return df.withColumn(name, F.col(amount) * (1 + rate))
