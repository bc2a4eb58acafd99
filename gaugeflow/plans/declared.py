"""Tables whose columns are declared without a formula. The formulas are ours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import rules
from gaugeflow.functions.times import boundaries
from gaugeflow.operators.grouping import latest_per
from gaugeflow.operators.ordered import SMALL, group_size, neighbour, rolling_range, rolling_rows, running
from gaugeflow.plans.gold import DAY, with_date
from gaugeflow.plans.reports import anomalies, key_statistics
from gaugeflow.spec import ROLES, Roles, anchor


def global_mart_extras(mart: DataFrame, staged: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Temperature range, 7-day average and stored events per date."""
    events = (
        with_date(staged, r=r)
        .groupBy("observation_date")
        .agg(F.count(rules.event_detected(r)).alias("extreme_event_count"))
    )
    rolled = rolling_rows(
        mart.select("observation_date", "global_avg_temp", "global_max_temp", "global_min_temp"),
        [],
        ["observation_date"],
        {"avg_temp_rolling_7d": ("avg", "global_avg_temp", 7)},
        SMALL,  # one row per date
    )
    return rolled.withColumn("temp_range", F.col("global_max_temp") - F.col("global_min_temp")).join(
        events, "observation_date", "left"
    )


def daily_extras(daily: DataFrame) -> DataFrame:
    """Temperature range, and whether a day has a reading for every hour."""
    return daily.withColumns(
        {
            "temperature_range": F.col("max_temperature") - F.col("min_temperature"),
            "is_complete_day": F.col("record_count") >= 24,
        }
    )


def rolling_extremes(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Lowest and highest temperature of the last 24 hours."""
    return rolling_range(
        rows.select(r.key, r.time, r.temperature),
        [r.key],
        r.time,
        {
            "rolling_24h_min_temp": ("min", r.temperature, DAY),
            "rolling_24h_max_temp": ("max", r.temperature, DAY),
        },
    )


def quality_mart(silver: DataFrame, as_of=None, checked: Column | None = None, r: Roles = ROLES) -> DataFrame:
    """Quality per key and date: score, completeness of 24 readings, age, status, failed checks."""
    per_day = (
        with_date(silver, "date", r)
        .groupBy(r.key, "date")
        .agg(
            F.count(F.lit(1)).alias("total_readings"),
            F.count_if("is_valid").alias("valid_readings"),
            F.sum(F.col("quality_checks_total") - F.col("quality_checks_passed")).alias("issues_detected"),
            F.max(r.time).alias("_newest"),
        )
    )
    n, ok = F.col("total_readings"), F.col("valid_readings")
    score = F.col("quality_score")
    status = rules.ladder(
        (score >= 95, "Excellent"), (score >= 85, "Good"), (score >= 70, "Fair"), (score >= 50, "Poor"),
        otherwise="Critical",
    )
    return per_day.withColumns(
        {
            "invalid_readings": n - ok,
            "quality_score": ok / n * 100.0,
            "data_completeness": F.least(n / 24.0, F.lit(1.0)) * 100.0,
            "freshness_hours": boundaries("HOUR", F.col("_newest"), anchor(as_of, silver, r.time)),
            "last_checked": checked if checked is not None else F.current_timestamp(),
        }
    ).withColumn("quality_status", status).drop("_newest")


def persistence_forecast(daily: DataFrame, horizon_days: int = 1, r: Roles = ROLES) -> DataFrame:
    """Forecast that repeats the daily average of ``horizon_days`` before."""
    return daily.select(
        r.key,
        F.date_add("observation_date", horizon_days).alias("forecast_date"),
        F.lit(horizon_days * 24).alias("forecast_horizon_hours"),
        F.col("avg_temperature").alias("predicted_temp"),
    )


def forecast_accuracy(predictions: DataFrame, daily: DataFrame, tolerance: float = 10, r: Roles = ROLES) -> DataFrame:
    """Predictions against what was observed."""
    actual = daily.select(
        r.key, F.col("observation_date").alias("forecast_date"), F.col("avg_temperature").alias("actual_temp")
    )
    return with_errors(predictions.join(actual, [r.key, "forecast_date"]), tolerance)


def with_errors(met: DataFrame, tolerance: float = 10) -> DataFrame:
    """Errors and score of predictions next to what was observed."""
    error = F.abs(F.col("predicted_temp") - F.col("actual_temp"))
    return (
        met.withColumn("absolute_error", error)
        .withColumn("percentage_error", F.try_divide(F.col("absolute_error"), F.abs("actual_temp")) * 100)
        .withColumn("accuracy_score", F.greatest(F.lit(0.0), 100 - F.col("percentage_error")))
        .withColumn("is_accurate", F.col("percentage_error") <= tolerance)
    )


def anomaly_model(rows: DataFrame, days: int = 30, as_of=None, r: Roles = ROLES) -> DataFrame:
    """All readings of the period that lie more than one deviation off."""
    return anomalies(rows, days, days, as_of, r)


def correlations(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Correlations of the measures per key."""
    t, h, p, w = r.temperature, r.humidity, r.pressure, r.wind
    return rows.groupBy(r.key).agg(
        F.count(F.lit(1)).alias("readings"),
        F.corr(t, h).alias("temp_humidity"),
        F.corr(t, p).alias("temp_pressure"),
        F.corr(t, w).alias("temp_wind"),
        F.corr(h, p).alias("humidity_pressure"),
        F.corr(h, w).alias("humidity_wind"),
        F.corr(p, w).alias("pressure_wind"),
    )


def station_metrics(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Statistics per key with the span of its readings."""
    span = F.timestamp_diff("HOUR", F.date_trunc("HOUR", "first_record"), F.date_trunc("HOUR", "last_record")) + 1
    return key_statistics(rows, r).withColumn("hours_covered", span)


def event_episodes(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Runs of consecutive readings of a key with the same event, with their duration."""
    flagged = rows.select(r.key, r.time, rules.event_detected(r).alias("event_type"))
    size = group_size(flagged, [r.key])
    near = neighbour(flagged, [r.key], [r.time], {"_before": "event_type"}, size=size)
    starts = F.when(F.col("event_type").eqNullSafe(F.col("_before")), 0).otherwise(1)
    numbered = running(near, [r.key], [r.time], {"episode": ("sum", starts)}, size)
    return (
        numbered.filter("event_type IS NOT NULL")
        .groupBy(r.key, "event_type", "episode")
        .agg(F.count(F.lit(1)).alias("readings"), F.min(r.time).alias("started"), F.max(r.time).alias("ended"))
        .withColumn("event_duration_minutes", F.timestamp_diff("MINUTE", "started", "ended"))
        .drop("episode")
    )


def history(log: DataFrame, keys: Sequence[str], updated: str) -> DataFrame:
    """Versions of each key with the span they were current; the open one ends with NULL."""
    size = group_size(log, keys)  # an upper bound for the versions
    single = latest_per(log, [*keys, updated], *[c for c in log.columns if c not in (*keys, updated)])
    return neighbour(single, keys, [updated], {"valid_to": updated}, ahead=True, size=size).withColumn(
        "valid_from", F.col(updated)
    )


