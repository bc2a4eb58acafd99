"""The raw layer: records as they arrive, one JSON text per observation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.times import from_epoch, parsed
from gaugeflow.operators.grouping import latest_per
from gaugeflow.sources import schemas
from gaugeflow.spec import anchor

SCAN_COLUMNS = ("ingestion_id", "ingestion_time", "source_city", "raw_payload")


def build_raw(
    observations: DataFrame,
    key: str,
    payload: Sequence[str] | None = None,
    source: str = "openweathermap",
    ingestion_id: Column | None = None,
    ingestion_time: Column | None = None,
    response_time: Column | None = None,
) -> DataFrame:
    """Raw records of typed rows: identifier, load time, source, key, JSON text, response time.

    The identifier is random by default. Give a hash of the content where a
    repeated load has to give the same identifiers.
    """
    fields = list(payload or observations.columns)
    return observations.select(
        (ingestion_id if ingestion_id is not None else F.uuid()).alias("ingestion_id"),
        (ingestion_time if ingestion_time is not None else F.current_timestamp()).alias("ingestion_time"),
        F.lit(source).alias("source"),
        F.col(key).cast("string").alias("source_city"),
        F.to_json(F.struct(*fields)).alias("raw_payload"),
        F.coalesce(response_time if response_time is not None else F.lit(None).cast("double"), F.lit(0.0)).alias(
            "api_response_time"
        ),
    )


def from_api(landed: DataFrame, payload: str, key: str) -> DataFrame:
    """Flat records from nested API answers: struct fields, first array element, epoch seconds."""
    doc = F.from_json(F.col(payload), schemas.API_PAYLOAD)
    first = F.get(F.col("_doc.weather"), F.lit(0))
    return landed.withColumn("_doc", doc).select(
        F.col(key).alias("city"),
        F.col("_doc.main.temp").alias("temperature"),
        F.col("_doc.main.humidity").alias("humidity"),
        F.col("_doc.main.pressure").alias("pressure"),
        F.col("_doc.wind.speed").alias("wind_speed"),
        first["main"].alias("weather_main"),
        first["description"].alias("weather_description"),
        from_epoch(F.col("_doc.dt")).alias("timestamp"),
    )


def scan(raw: DataFrame) -> DataFrame:
    """The columns the silver step needs; the others are not read."""
    return raw.select(*SCAN_COLUMNS)


def scan_increment(raw: DataFrame, hours: int = 24) -> DataFrame:
    """Records loaded within ``hours`` before the newest load."""
    newest = raw.agg((F.max("ingestion_time") - F.expr(f"INTERVAL {int(hours)} HOURS")).alias("since"))
    return scan(raw).filter(F.col("ingestion_time") >= newest.scalar())


def flatten(raw: DataFrame, time_type: str = "timestamp") -> DataFrame:
    """Typed columns of the JSON text. Bad fields become NULL, bad times too."""
    doc = F.from_json(F.col("raw_payload"), schemas.FLAT_PAYLOAD)
    return raw.withColumn("_doc", doc).select(
        "ingestion_id",
        "ingestion_time",
        "source_city",
        "_doc.temperature",
        "_doc.humidity",
        "_doc.pressure",
        "_doc.wind_speed",
        "_doc.weather_main",
        "_doc.weather_description",
        parsed(F.col("_doc.timestamp")).cast(time_type).alias("observation_time"),
    )


def snapshot(log: DataFrame, keys: Sequence[str], as_of, ingest_time: str = "ingestion_time", *tie: str) -> DataFrame:
    """The table as it was at a time: of each key, the newest record loaded by then."""
    return latest_per(log.filter(F.col(ingest_time) <= anchor(as_of, log, ingest_time)), keys, ingest_time, *tie)


def retained(raw: DataFrame, days: int = 30, as_of=None, column: str = "ingestion_time") -> DataFrame:
    """Records of the last ``days`` days."""
    return raw.filter(F.col(column) >= anchor(as_of, raw, column) - F.expr(f"INTERVAL {int(days)} DAYS"))
