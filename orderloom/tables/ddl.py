"""Schemas, tables, and plain writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{place}")


def schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES")


def drop_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP NAMESPACE IF EXISTS {name} CASCADE")


def create_table(
    spark: SparkSession,
    name: str,
    columns: str,
    provider: str = "parquet",
    partitioned_by: str | None = None,
) -> None:
    """`columns` and `partitioned_by` are DDL; transforms need a catalog that has them."""
    parts = f" PARTITIONED BY ({partitioned_by})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}{parts}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def add_column(spark: SparkSession, table: str, column: str, kind: str) -> None:
    spark.sql(f"ALTER TABLE {table} ADD COLUMN {column} {kind}")


def tables(spark: SparkSession, schema: str) -> DataFrame:
    """Stored tables; the session's temporary views are listed with every schema."""
    return spark.sql(f"SHOW TABLES IN {schema}").where("NOT isTemporary").select("tableName")


def missing_tables(spark: SparkSession, schema: str, expected: list[str]) -> DataFrame:
    wanted = spark.createDataFrame([(t,) for t in expected], "tableName string")
    return wanted.join(tables(spark, schema), on="tableName", how="left_anti")


def describe(spark: SparkSession, table: str, extended: bool = False) -> DataFrame:
    return spark.sql(f"DESCRIBE {'EXTENDED ' if extended else ''}{table}")


def table_type(spark: SparkSession, table: str) -> str:
    return spark.catalog.getTable(table).tableType


def location(spark: SparkSession, table: str) -> str:
    """Where a table's files lie."""
    facts = describe(spark, table, extended=True).where("col_name = 'Location'")
    return facts.first()["data_type"]


def append(df: DataFrame, table: str) -> None:
    """Add rows to a table: by name where the catalog has V2 writes, else by position."""
    if _has_own_catalog(table):
        df.writeTo(table).append()
    else:
        spark = df.sparkSession
        df.select(*spark.table(table).columns).write.insertInto(table)


def replace_measured(df: DataFrame, table: str, **measures: Column) -> dict:
    """`replace`, and aggregates of the rows taken as they are written."""
    seen = Observation()
    replace(df.observe(seen, *(c.alias(k) for k, c in measures.items())), table)
    return seen.get


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Overwrite a table that lies by the hash of a key, sorted by it: tables alike join on the key without a shuffle.

    One shuffle at the write, however often the table is joined. As many files as buckets, so
    their number follows the table's size; rows of one key are one bucket's.
    """
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def replace(df: DataFrame, table: str, provider: str = "parquet") -> None:
    """Create the table from the frame, or replace what it holds."""
    if _has_own_catalog(table):
        df.writeTo(table).using(provider).createOrReplace()
    else:
        df.write.format(provider).mode("overwrite").saveAsTable(table)


def _has_own_catalog(table: str) -> bool:
    first, *rest = table.split(".")
    return len(rest) == 2 and first != "spark_catalog"


def copy_table(spark: SparkSession, source: str, target: str) -> DataFrame:
    replace(spark.table(source), target)
    return spark.table(target)


def insert_values(spark: SparkSession, table: str, values: str) -> None:
    spark.sql(f"INSERT INTO {table} VALUES {values}")


def insert_query(spark: SparkSession, table: str, query: str) -> None:
    spark.sql(f"INSERT INTO {table} {query}")


def by_day(moment: str) -> dict[str, Column]:
    """The day as a partition column; filter on it to prune partitions."""
    return {"day": F.to_date(moment)}


def by_hour(moment: str) -> dict[str, Column]:
    return {"hour": F.date_format(moment, "yyyy-MM-dd-HH")}


def write_partitioned(df: DataFrame, table: str, partition: dict[str, Column] | list[str]) -> None:
    """Overwrite a table partitioned by columns or by derived ones.

    REBALANCE brings a partition's rows together, so a table gets few files, yet
    splits a partition that is too large for one task.
    """
    if isinstance(partition, dict):
        df = df.withColumns(partition)
    names = list(partition)
    df.hint("rebalance", *names).write.mode("overwrite").partitionBy(*names).saveAsTable(table)


def storage_matches(spark: SparkSession, table: str) -> DataFrame:
    """One row: rows by way of the catalog and of the files, and whether they agree."""
    rows = F.count("*")
    files = spark.read.parquet(location(spark, table))
    counted = spark.table(table).agg(rows.alias("table_rows"))
    both = counted.select("table_rows", files.agg(rows).scalar().alias("file_rows"))
    return both.withColumn("matches", F.col("table_rows") == F.col("file_rows"))
