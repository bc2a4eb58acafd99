"""Raw records to scored, de-duplicated observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.rules import CHECKS, in_range, quality_checks
from gaugeflow.functions.times import to_utc
from gaugeflow.operators.grouping import latest_per
from gaugeflow.sources.raw import flatten
from gaugeflow.spec import ROLES, Roles, since_days


def score(df: DataFrame, r: Roles = ROLES) -> DataFrame:
    return df.withColumn("quality_checks_passed", quality_checks(r)).withColumns(
        {
            "quality_checks_total": F.lit(CHECKS),
            "is_valid": F.col("quality_checks_passed") == CHECKS,
        }
    )


def validate(df: DataFrame, r: Roles = ROLES) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) incoming records."""
    return df.filter(in_range(r)), df.filter(~in_range(r))


def standardise_times(df: DataFrame, zone: str = "UTC", column: str = ROLES.time) -> DataFrame:
    """Adds the time in UTC; ``column`` holds wall-clock time of ``zone``."""
    return df.withColumn(f"{column}_utc", to_utc(F.col(column), zone))


def clean(
    raw: DataFrame, processed: Column | None = None, time_type: str = "timestamp", keep_load_time: bool = False
) -> DataFrame:
    """Silver rows of raw records: parse, keep the latest load of each (key, time), score."""
    flat = flatten(raw, time_type).withColumnRenamed("temperature", ROLES.temperature)
    single = latest_per(flat, ["source_city", "observation_time"], "ingestion_time", "ingestion_id")
    scored = score(single)
    columns = [
        F.col("source_city").alias("city"),
        "temperature_celsius",
        "humidity",
        "pressure",
        "wind_speed",
        "weather_main",
        "weather_description",
        "observation_time",
        "ingestion_id",
        (processed if processed is not None else F.current_timestamp()).alias("processed_time"),
        "is_valid",
        "quality_checks_passed",
        "quality_checks_total",
    ]
    return scored.select(*columns, *(["ingestion_time"] if keep_load_time else []))


def passing(records: DataFrame, processed: Column | None = None) -> DataFrame:
    """Silver rows of records already accepted at the door: all checks passed."""
    return records.withColumns(
        {
            "processed_time": processed if processed is not None else F.current_timestamp(),
            "is_valid": F.lit(True),
            "quality_checks_passed": F.lit(CHECKS),
            "quality_checks_total": F.lit(CHECKS),
        }
    )


def valid(silver: DataFrame, days: int | None = None, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Valid rows, from midnight ``days`` days before the anchor on if given."""
    rows = silver.filter("is_valid")
    return rows if days is None else since_days(rows, days, as_of, r.time)


def staging(silver: DataFrame, ingestion_id: str = "sample", processed: Column | None = None, r: Roles = ROLES) -> DataFrame:
    """Valid rows under the names models build on."""
    return silver.filter("is_valid").select(
        r.key,
        r.temperature,
        r.humidity,
        r.pressure,
        r.wind,
        r.category,
        r.description,
        r.time,
        F.lit(ingestion_id).alias("ingestion_id"),
        (processed if processed is not None else F.current_timestamp()).alias("processed_time"),
    )
