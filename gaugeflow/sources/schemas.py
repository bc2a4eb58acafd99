"""Table schemas and layouts (column names are fixed values)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# A folder for each key costs a file for each, and keys have no bound: tables take that many folders for all of them.
BUCKETS = 64
# Nested form, as an API sends it.
API_PAYLOAD = (
    "main struct<temp: double, humidity: int, pressure: int>, wind struct<speed: double>, "
    "weather array<struct<main: string, description: string>>, dt bigint"
)
# Flat form, as the raw table keeps it.
FLAT_PAYLOAD = (
    "city string, temperature double, humidity int, pressure int, wind_speed double, "
    "weather_main string, weather_description string, timestamp string, api_response_time double"
)
RAW = (
    "ingestion_id string, ingestion_time timestamp, source string, source_city string, "
    "raw_payload string, api_response_time double"
)
SILVER = (
    "city string, temperature_celsius double, humidity int, pressure int, wind_speed double, "
    "weather_main string, weather_description string, observation_time timestamp, ingestion_id string, "
    "processed_time timestamp, is_valid boolean, quality_checks_passed int, quality_checks_total int"
)
DAILY = (
    "city string, observation_date date, avg_temperature double, max_temperature double, min_temperature double, "
    "avg_humidity double, avg_wind_speed double, record_count bigint, most_common_weather string, "
    "temp_category string, last_updated timestamp"
)
TREND = (
    "city string, observation_time timestamp, temperature_celsius double, rolling_24h_avg_temp double, "
    "rolling_7d_avg_temp double, temp_change_24h double, temp_change_pct double, trend_direction string, "
    "last_updated timestamp"
)
EVENTS = (
    "city string, observation_time timestamp, temperature_celsius double, wind_speed double, weather_main string, "
    "weather_description string, event_type string, detection_time timestamp"
)


def bucket(key: Column | str) -> Column:
    """The folder of a key, from 0; NULL has one as well."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class Layout:
    """Schema and partition columns of a table.

    ``key`` names a text column that the table is partitioned by. Its rows stand in ``BUCKETS`` folders of
    ``<key>_bucket``, sorted by the key in each file, however many keys there are. ``derived`` computes that
    column for writers, ``holds`` selects the rows of a key from its folder alone.
    """

    schema: str
    partition_by: tuple[str, ...] = field(default=())
    key: str | None = None

    @property
    def stored(self) -> str:
        """The schema as read back: with the column of the folders."""
        return f"{self.schema}, {self.key}_bucket int" if self.key else self.schema

    @property
    def derived(self) -> dict[str, Column]:
        return {f"{self.key}_bucket": bucket(self.key)} if self.key else {}

    @property
    def order(self) -> tuple[str, ...]:
        """What files are sorted by."""
        return (self.key,) if self.key else ()

    def holds(self, value: str | None) -> Column:
        text = F.lit(value).cast("string")
        return F.col(self.key).eqNullSafe(text) & (F.col(f"{self.key}_bucket") == bucket(text))


TABLES = {
    "raw": Layout(RAW, ("source", "source_city_bucket"), "source_city"),
    "silver": Layout(SILVER, ("city_bucket",), "city"),
    "daily": Layout(DAILY, ("city_bucket", "observation_date"), "city"),
    "trend": Layout(TREND, ("city_bucket",), "city"),
    "events": Layout(EVENTS, ("city_bucket",), "city"),
}
