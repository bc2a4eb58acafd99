"""Differences and conversions of times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def boundaries(unit: str, start: Column, end: Column) -> Column:
    """How many starts of ``unit`` (HOUR, MINUTE, DAY ..) lie between two times.

    10:59 to 11:01 is one hour boundary, though less than an hour.
    """
    return F.timestamp_diff(unit, F.date_trunc(unit, start), F.date_trunc(unit, end))


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours as a fraction."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3_600_000_000.0)


def parsed(text: Column) -> Column:
    """Timestamp of a text, NULL where it is none."""
    return F.try_to_timestamp(text)


def to_utc(time: Column, zone: str = "UTC") -> Column:
    """Wall-clock time of ``zone`` as UTC."""
    return F.to_utc_timestamp(time, zone)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def minute_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm")
