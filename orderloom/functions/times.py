"""Timestamps: parsing, calendar features, durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two forms an event time comes in.
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def iso_timestamp(text: Column) -> Column:
    """Strict: an unreadable value fails the job under ANSI mode."""
    return F.to_timestamp(F.replace(text, F.lit("T"), F.lit(" ")))


def patterned_timestamp(text: Column, pattern: str = MICROS) -> Column:
    return F.to_timestamp(text, pattern)


def tolerant_timestamp(text: Column, patterns: tuple[str, ...] = (MICROS, SECONDS)) -> Column:
    """The first pattern that reads the value; NULL when none does."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(p)) for p in patterns))


def weekend(moment: Column) -> Column:
    """True on Saturday and Sunday (day 7 and day 1)."""
    return F.when(F.dayofweek(moment).isin(1, 7), True).otherwise(False)


def calendar_features(moment: Column) -> dict[str, Column]:
    return {
        "event_hour": F.hour(moment),
        "event_day_of_week": F.dayofweek(moment),
        "is_weekend": weekend(moment),
        "event_date": F.to_date(moment),
    }


def minutes_between(later: Column, earlier: Column) -> Column:
    """Whole seconds apart, as minutes."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 60
