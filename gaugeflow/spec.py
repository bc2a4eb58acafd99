"""Role names of an observation table, and time anchors."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Roles:
    """Which column of a table plays which part."""

    key: str = "city"
    time: str = "observation_time"
    temperature: str = "temperature_celsius"
    humidity: str = "humidity"
    pressure: str = "pressure"
    wind: str = "wind_speed"
    category: str = "weather_main"
    description: str = "weather_description"
    ingest_time: str = "ingestion_time"
    ingestion_id: str = "ingestion_id"
    processed_time: str = "processed_time"


ROLES = Roles()


def anchor(as_of: str | datetime | None, like: DataFrame | None = None, column: str | None = None) -> Column:
    """``as_of`` as a column of the type of ``like[column]``; now if it is None.

    Text is cast rather than a Python datetime passed, so that the value does
    not depend on the zone of the driver process.
    """
    kind = like.schema[column].dataType.simpleString() if like is not None else "timestamp"
    if kind not in ("timestamp", "timestamp_ntz"):
        kind = "timestamp"
    if as_of is None:
        return F.current_timestamp().cast(kind)
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast(kind)


def since_days(df: DataFrame, days: int, as_of=None, column: str = ROLES.time) -> DataFrame:
    """Rows from midnight ``days`` days before the anchor's date on.

    The bound folds to a literal, so it reaches the scan as a pushed filter.
    """
    kind = df.schema[column].dataType
    start = F.date_sub(F.to_date(anchor(as_of, df, column)), days)
    return df.filter(F.col(column) >= (start if kind.simpleString() == "date" else start.cast(kind)))


def since_hours(df: DataFrame, hours: int, as_of=None, column: str = ROLES.time) -> DataFrame:
    """Rows of the last ``hours`` hours before the anchor."""
    return df.filter(F.col(column) >= anchor(as_of, df, column) - F.expr(f"INTERVAL {int(hours)} HOURS"))


def split_at(df: DataFrame, as_of=None, column: str = ROLES.time) -> tuple[DataFrame, DataFrame]:
    """(past, future) parts of a series: up to and including the anchor, and after it."""
    now = anchor(as_of, df, column)
    return df.filter(F.col(column) <= now), df.filter(F.col(column) > now)
