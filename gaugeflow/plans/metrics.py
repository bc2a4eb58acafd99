"""Metric points ``(name, value, timestamp, tags, unit)`` as rows, and alerts.

Metric names and units are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import rules
from gaugeflow.functions.scalars import fixed_point
from gaugeflow.functions.times import hours_between
from gaugeflow.sources.storage import dataset_profile
from gaugeflow.spec import ROLES, Roles, anchor, since_hours

NO_TAGS = "map<string,string>"


def _points(line: DataFrame, points: list[tuple[str, Column, str]], at: Column, tags: dict[str, str] | None = None) -> DataFrame:
    """Metric rows of a one-line table; absent values give no row."""
    pairs = [F.lit(x) for kv in (tags or {}).items() for x in kv]
    label = F.create_map(*pairs) if pairs else F.create_map().cast(NO_TAGS)
    entries = [
        F.struct(
            F.lit(name).alias("name"),
            value.cast("double").alias("value"),
            at.alias("timestamp"),
            label.alias("tags"),
            F.lit(unit).alias("unit"),
        )
        for name, value, unit in points
    ]
    return line.select(F.inline(F.array(*entries))).filter("value IS NOT NULL")


def pipeline_metrics(raw: DataFrame, silver: DataFrame, hours: int = 24, as_of=None, r: Roles = ROLES) -> DataFrame:
    now = anchor(as_of, raw, r.ingest_time)
    loads = since_hours(raw, hours, as_of, r.ingest_time).agg(
        F.count(F.lit(1)).alias("n"), F.max(r.ingest_time).alias("last")
    )
    scored = since_hours(silver, hours, as_of, r.processed_time).agg(
        F.count(F.lit(1)).alias("n"), F.avg("quality_checks_passed").alias("score")
    )
    return _points(
        loads,
        [
            ("ingestion.total_records_24h", F.col("n"), "records"),
            ("ingestion.hours_since_last", hours_between(F.col("last"), now), "hours"),
        ],
        now,
    ).unionByName(
        _points(
            scored,
            [
                ("silver.total_records_24h", F.col("n"), "records"),
                ("silver.avg_quality_score", F.col("score"), "score"),
            ],
            now,
        )
    )


def table_metrics(tables: dict[str, DataFrame], as_of=None, prefix: str = "delta") -> DataFrame:
    """Bytes, files and rows of file-based tables."""
    out = None
    for name, df in tables.items():
        part = _points(
            dataset_profile(df),
            [
                (f"{prefix}.{name}.size_bytes", F.col("size_bytes"), "bytes"),
                (f"{prefix}.{name}.num_files", F.col("num_files"), "files"),
                (f"{prefix}.{name}.num_records", F.col("num_records"), "records"),
            ],
            anchor(as_of),
        )
        out = part if out is None else out.unionByName(part)
    return out


def weather_metrics(silver: DataFrame, hours: int = 24, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Mean of the key averages and the extremes of the last hours."""
    per_key = (
        since_hours(silver, hours, as_of, r.time)
        .groupBy(r.key)
        .agg(F.avg(r.temperature).alias("a"), F.max(r.temperature).alias("hi"), F.min(r.temperature).alias("lo"))
    )
    line = per_key.agg(F.avg("a").alias("a"), F.max("hi").alias("hi"), F.min("lo").alias("lo"))
    return _points(
        line,
        [
            ("weather.global_avg_temp", F.col("a"), "celsius"),
            ("weather.global_max_temp", F.col("hi"), "celsius"),
            ("weather.global_min_temp", F.col("lo"), "celsius"),
        ],
        anchor(as_of, silver, r.time),
        {"period": f"{hours}h"},
    )


def quality_metrics(silver: DataFrame, hours: int = 24, as_of=None, r: Roles = ROLES) -> DataFrame:
    line = since_hours(silver, hours, as_of, r.time).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_valid").alias("valid"),
        F.avg("quality_checks_passed").alias("score"),
    )
    return _points(
        line,
        [
            ("quality.total_records", F.col("n"), "records"),
            ("quality.valid_records", F.col("valid"), "records"),
            ("quality.valid_ratio", F.try_divide(F.col("valid") * 100.0, F.col("n")), "percent"),
            ("quality.avg_score", F.coalesce("score", F.lit(0.0)), "score"),
        ],
        anchor(as_of, silver, r.time),
    )


def metric_history(metrics: DataFrame, name: str, hours: int = 24, as_of=None) -> DataFrame:
    return since_hours(metrics.filter(F.col("name") == F.lit(name)), hours, as_of, "timestamp")


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Newest value, extremes, mean, count and unit per metric."""
    newest, oldest = F.struct("timestamp", "value"), F.struct("timestamp", "unit")
    return metrics.groupBy("name").agg(
        F.max(newest)["value"].alias("current"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("avg"),
        F.count("value").alias("count"),
        F.min(oldest)["unit"].alias("unit"),
    )


# ---------------------------------------------------------------- alerts
# Titles, messages and sources are fixed values.


def _alert(title: Column, message: Column, severity: Column, source: str) -> list[Column]:
    return [
        title.alias("title"),
        message.alias("message"),
        severity.alias("severity"),
        F.lit(source).alias("source"),
    ]


def quality_alert(summary: DataFrame) -> DataFrame:
    """Alert row of a check summary."""
    text = F.format_string(
        "Data quality check completed. Total checks: %d, critical alerts: %d, warning alerts: %d, info alerts: %d",
        "total_checks",
        "critical_alerts",
        "warning_alerts",
        "info_alerts",
    )
    return summary.select(
        *_alert(
            F.format_string("Data Quality Report - %d checks", "total_checks"),
            text,
            rules.report_severity(F.col("critical_alerts"), F.col("warning_alerts")),
            "weather-platform-quality",
        )
    )


def run_alerts(runs: DataFrame) -> DataFrame:
    """Alert rows of runs ``(pipeline, status, duration_seconds, error)``."""
    failed = F.col("status") == "failure"
    seconds = fixed_point(F.col("duration_seconds"), 2)
    title = F.concat(
        F.when(failed, F.lit("Pipeline Failed: ")).otherwise(F.lit("Pipeline Succeeded: ")), F.col("pipeline")
    )
    message = F.when(
        failed, F.format_string("Pipeline %s failed after %s seconds.", "pipeline", seconds)
    ).otherwise(F.format_string("Pipeline %s completed successfully in %s seconds.", "pipeline", seconds))
    return runs.select(
        "pipeline",
        "status",
        "duration_seconds",
        "error",
        *_alert(
            title, message, rules.run_severity(F.col("status"), F.col("error")), "weather-platform-pipeline"
        ),
    )


def threshold_alerts(events: DataFrame, key: str = ROLES.key) -> DataFrame:
    """Alert rows of events ``(key, event_kind, value, threshold)``."""
    kind = F.col("event_kind")
    value, threshold = fixed_point(F.col("value"), 1), fixed_point(F.col("threshold"), 1)
    message = (
        F.when(
            kind == "heatwave",
            F.format_string("Temperature of %s°C exceeds threshold of %s°C", value, threshold),
        )
        .when(
            kind == "storm",
            F.format_string("Wind speed of %s km/h exceeds threshold of %s km/h", value, threshold),
        )
        .when(kind == "heavy_rain", F.concat(F.lit("Heavy rain detected in "), F.col(key)))
        .when(kind == "cold_wave", F.format_string("Temperature of %s°C is below %s°C", value, threshold))
        .otherwise(F.concat(F.lit("Extreme weather event in "), F.col(key)))
    )
    title = F.concat(F.lit("Extreme Weather Alert: "), F.col(key))
    return events.select(
        key, kind, "value", "threshold", *_alert(title, message, F.lit("warning"), "weather-platform-weather")
    )
