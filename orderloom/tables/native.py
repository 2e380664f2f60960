"""Statements for catalogs with row-level changes, snapshots and procedures.

They need such a catalog's jar on the classpath; plain parquet tables reject them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession


def update(table: str, changes: dict[str, str], condition: str) -> str:
    sets = ", ".join(f"{column} = {value}" for column, value in changes.items())
    return f"UPDATE {table} SET {sets} WHERE {condition}"


def delete(table: str, condition: str) -> str:
    return f"DELETE FROM {table} WHERE {condition}"


def as_of_version(table: str, snapshot: int) -> str:
    return f"SELECT * FROM {table} VERSION AS OF {snapshot}"


def as_of_time(table: str, moment: datetime) -> str:
    return f"SELECT * FROM {table} TIMESTAMP AS OF '{moment:%Y-%m-%d %H:%M:%S}'"


def metadata(table: str, kind: str) -> str:
    """`history`, `snapshots`, `files` or `partitions` of a table."""
    return f"SELECT * FROM {table}.{kind}"


def _call(catalog: str, procedure: str, **arguments: str) -> str:
    given = ", ".join(f"{name} => {value}" for name, value in arguments.items())
    return f"CALL {catalog}.system.{procedure}({given})"


def _moment(moment: datetime) -> str:
    return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"


def compact(catalog: str, table: str, target_bytes: int, min_files: int) -> str:
    options = f"map('target-file-size-bytes', '{target_bytes}', 'min-input-files', '{min_files}')"
    return _call(catalog, "rewrite_data_files", table=f"'{table}'", options=options)


def expire(catalog: str, table: str, older_than: datetime, retain: int) -> str:
    return _call(
        catalog, "expire_snapshots",
        table=f"'{table}'", older_than=_moment(older_than), retain_last=str(retain),
    )


def remove_orphans(catalog: str, table: str, older_than: datetime) -> str:
    return _call(catalog, "remove_orphan_files", table=f"'{table}'", older_than=_moment(older_than))


def run(spark: SparkSession, statement: str) -> DataFrame:
    return spark.sql(statement)
