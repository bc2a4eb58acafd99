"""Structured Streaming forms of the silver step and the daily summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeflow.functions import rules
from gaugeflow.plans.declared import with_errors
from gaugeflow.plans.silver import clean
from gaugeflow.sources.storage import upsert
from gaugeflow.spec import ROLES, Roles


def raw_to_silver(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    processed: Column | None = None,
    time_type: str = "timestamp",
    partition_by: tuple[str, ...] = ("observation_date",),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch of raw records; the latest load of a reading stays.

    The load time is kept with the table, so a record that arrives late does not
    replace a newer one, and a repeated batch changes nothing. The table is
    partitioned by the day of the reading: a batch rewrites the days it touches.
    """
    days = {"observation_date": F.to_date("observation_time")} if "observation_date" in partition_by else {}

    def merge(batch: DataFrame, _: int) -> None:
        silver = clean(batch, processed, time_type, keep_load_time=True)
        newest = ("ingestion_time", "ingestion_id")
        upsert(silver, path, ["city", "observation_time"], partition_by, newest, derived=days)

    return (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _zoned(rows: DataFrame, r: Roles) -> DataFrame:
    """Watermarks need a TIMESTAMP."""
    return rows.withColumn(r.time, F.col(r.time).cast("timestamp"))


def first_wins(rows: DataFrame, lateness: str = "24 hours", r: Roles = ROLES) -> DataFrame:
    """Keep the first record of each reading; state is dropped after ``lateness``."""
    kept = _zoned(rows, r).withWatermark(r.time, lateness).dropDuplicatesWithinWatermark([r.key, r.time])
    return kept.withColumn(r.time, F.col(r.time).cast(rows.schema[r.time].dataType))


def daily_summary(rows: DataFrame, lateness: str = "24 hours", r: Roles = ROLES) -> DataFrame:
    """Per key and day; a day is final once the watermark has passed its end."""
    # windows are cut in UTC: let them see the wall clock of the session zone
    wall = F.from_utc_timestamp(F.col(r.time), F.current_timezone())
    start = F.date_from_unix_date((F.unix_seconds("_day.start") / 86_400).cast("int"))
    return (
        _zoned(rows, r)
        .withColumn(r.time, wall)
        .withWatermark(r.time, lateness)
        .groupBy(F.window(r.time, "1 day").alias("_day"), r.key)
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.avg(r.temperature).alias("avg_temperature"),
            F.max(r.temperature).alias("max_temperature"),
            F.min(r.temperature).alias("min_temperature"),
            F.avg(r.humidity).alias("avg_humidity"),
            F.avg(r.wind).alias("avg_wind_speed"),
        )
        .select(
            r.key,
            start.alias("observation_date"),
            "record_count",
            "avg_temperature",
            "max_temperature",
            "min_temperature",
            "avg_humidity",
            "avg_wind_speed",
        )
    )


def event_sessions(rows: DataFrame, gap: str = "1 hour", lateness: str = "24 hours", r: Roles = ROLES) -> DataFrame:
    """Episodes of a key's event: its readings with less than ``gap`` from one to the next.

    As a stream, an episode is given once the watermark, ``lateness`` behind the newest reading,
    has passed its end; a late reading until then joins the episodes before and after it into one. State
    holds open episodes only. Of a table, all episodes are given at once.
    """
    flagged = _zoned(rows.withColumn("event_type", rules.event_detected(r)), r)
    # all readings move the watermark, also those without an event: a condition on the time stays above it
    events = flagged.withWatermark(r.time, lateness).filter(F.when(F.col(r.time).isNotNull(), F.col("event_type")).isNotNull())
    kind = rows.schema[r.time].dataType
    ends = [F.min(r.time).cast(kind).alias("started"), F.max(r.time).cast(kind).alias("ended")]
    found = events.groupBy(F.session_window(r.time, gap), r.key, "event_type").agg(F.count(F.lit(1)).alias("readings"), *ends)
    minutes = F.timestamp_diff("MINUTE", "started", "ended").alias("event_duration_minutes")
    return found.select(r.key, "event_type", "readings", "started", "ended", minutes)


def forecasts_met(predictions: DataFrame, daily: DataFrame, lateness: str = "2 days", tolerance: float = 10, r: Roles = ROLES) -> DataFrame:
    """Predictions against what was observed, as both arrive: ``forecast_accuracy`` of two streams.

    A pair is given when its later side comes. Both sides wait for the other within ``lateness``
    of the newest day of either; older ones can't be met any more and leave the state.
    """
    p = predictions.withColumn("_due", F.col("forecast_date").cast("timestamp")).withWatermark("_due", lateness)
    a = daily.select(
        F.col(r.key).alias("_key"), F.col("observation_date").cast("timestamp").alias("_day"), F.col("avg_temperature").alias("actual_temp")
    ).withWatermark("_day", lateness)
    met = p.join(a, (F.col(r.key) == F.col("_key")) & (F.col("_due") == F.col("_day")), "inner")
    return with_errors(met.drop("_key", "_due", "_day"), tolerance)


def append_to(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write finished rows of a stream as parquet."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
