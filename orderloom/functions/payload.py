"""JSON text to columns and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpack(df: DataFrame, text: Column, ddl: str, *keep: Column | str) -> DataFrame:
    """The payload's fields as columns, next to the `keep` columns."""
    parsed = df.select(F.from_json(text, ddl).alias("payload"), *keep)
    return parsed.select("payload.*", *(c for c in parsed.columns if c != "payload"))


def may_hold(text: Column, *parts: str) -> Column:
    """Whether the text can hold one of the parts; a backslash may hide one in an escape."""
    return reduce(lambda a, b: a | b, (text.contains(part) for part in (*parts, "\\")))


def parse_named(text: Column, fields: dict[str, str]) -> Column:
    """from_json, for texts that can name one of the fields; NULL for the others.

    Most events carry other keys only, and starting the parser costs more than
    searching the text. A backslash may hide a name in an escape, so such a text
    is parsed as well; the fields come out as from_json alone would give them.
    """
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
    return F.when(may_hold(text, *fields), F.from_json(text, ddl))


def json_value(text: Column, path: str, as_type: str) -> Column:
    """One JSON path; junk reads as NULL instead of failing the job."""
    return F.get_json_object(text, path).try_cast(as_type)


def as_message(df: DataFrame, key: Column, columns: list[str]) -> DataFrame:
    """Rows as key plus JSON value; NULL fields stay in the text."""
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(key.cast("string").alias("key"), value.alias("value"))
