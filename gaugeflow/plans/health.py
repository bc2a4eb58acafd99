"""Quality, freshness, completeness and volume of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import rules
from gaugeflow.functions.scalars import fixed_point, percentage
from gaugeflow.functions.times import boundaries
from gaugeflow.operators.checks import unique_combination
from gaugeflow.operators.grouping import value_counts
from gaugeflow.operators.ordered import neighbour
from gaugeflow.plans.gold import event_counts, with_date
from gaugeflow.plans.reports import seasonal_profile
from gaugeflow.spec import ROLES, Roles, anchor, since_days, since_hours


def quality_statistics(silver: DataFrame, r: Roles = ROLES) -> DataFrame:
    return silver.groupBy(r.key).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("is_valid").alias("valid_records"),
        F.avg("quality_checks_passed").alias("avg_quality_score"),
    )


def invalid_profile(silver: DataFrame, r: Roles = ROLES) -> DataFrame:
    invalid = silver.filter(~F.col("is_valid"))
    return value_counts(invalid, [r.key], "quality_checks_passed", "count").orderBy(F.desc("count"))


def quality_trend(silver: DataFrame, days: int = 7, r: Roles = ROLES) -> DataFrame:
    """Average score of the newest dates."""
    return (
        with_date(silver, "date", r)
        .groupBy("date")
        .agg(F.avg("quality_checks_passed").alias("avg_quality_score"), F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.desc("date"))
        .limit(days)
    )


def null_profile(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("raw_payload").isNull()).alias("null_payloads"),
        F.count_if(F.col("source_city").isNull()).alias("null_cities"),
    )


def duplicate_ids(raw: DataFrame) -> DataFrame:
    return unique_combination(raw, ["ingestion_id"], "duplicate_count")


def load_recency(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy("source_city")
        .agg(F.max("ingestion_time").alias("last_ingestion"), F.count(F.lit(1)).alias("total_records"))
        .orderBy(F.desc("last_ingestion"))
    )


def missing_measures(daily: DataFrame, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    recent = daily.filter(F.col("observation_date") >= F.date_sub(F.to_date(anchor(as_of)), days))
    return recent.groupBy(r.key).agg(
        F.count(F.lit(1)).alias("total_days"),
        F.count_if(F.col("avg_temperature").isNull()).alias("missing_temp"),
        F.count_if(F.col("avg_humidity").isNull()).alias("missing_humidity"),
    )


def freshness_days(daily: DataFrame, as_of=None, r: Roles = ROLES) -> DataFrame:
    newest = daily.groupBy(r.key).agg(F.max("observation_date").alias("latest_data_date"))
    return newest.withColumn("days_old", F.datediff(F.to_date(anchor(as_of)), "latest_data_date"))


def freshness(rows: DataFrame, unit: str = "HOUR", name: str = "hours_old", as_of=None, r: Roles = ROLES) -> DataFrame:
    """Age of the newest reading per key in unit boundaries."""
    newest = rows.groupBy(r.key).agg(F.max(r.time).alias("latest_time"))
    return newest.withColumn(name, boundaries(unit, F.col("latest_time"), anchor(as_of, rows, r.time)))


def stale_keys(rows: DataFrame, minutes: int = 120, as_of=None, r: Roles = ROLES) -> DataFrame:
    aged = freshness(rows, "MINUTE", "minutes_since_update", as_of, r)
    return aged.filter(F.col("minutes_since_update") > minutes)


def _daily_counts(rows: DataFrame, days: int, as_of, r: Roles) -> DataFrame:
    recent = since_days(rows, days, as_of, r.time).select(r.key, r.time)
    return with_date(recent, "date", r).groupBy(r.key, "date").agg(F.count(F.lit(1)).alias("hourly_readings"))


def completeness(rows: DataFrame, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Days with enough readings, per key."""
    status = rules.day_completeness(F.col("hourly_readings"))
    return (
        _daily_counts(rows, days, as_of, r)
        .withColumn("_status", status)
        .groupBy(r.key)
        .agg(
            F.count(F.lit(1)).alias("days_analyzed"),
            F.avg("hourly_readings").alias("avg_hourly_readings"),
            F.min("hourly_readings").alias("min_hourly_readings"),
            F.max("hourly_readings").alias("max_hourly_readings"),
            F.count_if(F.col("_status") == "Complete").alias("complete_days"),
            F.count_if(F.col("_status") == "Incomplete").alias("incomplete_days"),
        )
    )


def completeness_score(complete: DataFrame) -> DataFrame:
    return complete.withColumn("quality_score", percentage(F.col("complete_days"), F.col("days_analyzed"), 1))


def completeness_flag(complete: DataFrame, days: int = 5) -> DataFrame:
    """Whether enough of the days are complete."""
    return complete.withColumn(
        "completeness_flag", F.when(F.col("complete_days") >= days, F.lit("ok")).otherwise(F.lit("warning"))
    )


def volume(rows: DataFrame, days: int = 7, expected: int = 24, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Readings per date and key; low below 80 % of the expected number."""
    counts = _daily_counts(rows, days, as_of, r).withColumnRenamed("hourly_readings", "records")
    return counts.withColumn("is_low", F.col("records") < F.lit(expected * 0.8)).orderBy(F.desc("date"), r.key)


def validation(rows: DataFrame, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Out-of-range readings per measure and the share within all ranges."""

    def outside(c: str, low: float, high: float) -> Column:
        return F.count_if((F.col(c) < low) | (F.col(c) > high))

    counted = (
        since_days(rows, days, as_of, r.time)
        .groupBy(r.key)
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            outside(r.temperature, -50, 60).alias("temp_outliers"),
            outside(r.humidity, 0, 100).alias("humidity_outliers"),
            outside(r.wind, 0, 150).alias("wind_outliers"),
        )
    )
    total = F.col("temp_outliers") + F.col("humidity_outliers") + F.col("wind_outliers")
    return counted.withColumn("total_outliers", total).withColumn(
        "validation_rate", percentage(F.col("total_records") - F.col("total_outliers"), F.col("total_records"))
    )


def poor_validation(validated: DataFrame, below: float = 90) -> DataFrame:
    return validated.filter(F.col("validation_rate") < below)


# ---------------------------------------------------------------- checks with severities
# Names and texts of the checks are fixed values.


def _check(prefix: str, value: Column, expected: Column, severity: Column, text: Column, r: Roles) -> list[Column]:
    return [
        F.concat(F.lit(prefix), F.col(r.key)).alias("name"),
        value.cast("double").alias("value"),
        expected.cast("double").alias("expected"),
        severity.alias("severity"),
        text.alias("description"),
    ]


def freshness_check(rows: DataFrame, as_of=None, r: Roles = ROLES) -> DataFrame:
    hours = F.col("hours_old")
    text = F.concat(F.lit("Data freshness for "), F.col(r.key))
    severity = rules.freshness_severity(hours)
    return freshness(rows, as_of=as_of, r=r).select(*_check("freshness_", hours, F.lit(4), severity, text, r))


def _is_extreme(r: Roles) -> Column:
    return (F.col(r.temperature) > 35) | (F.col(r.temperature) < -10) | (F.col(r.wind) > 50)


def recent_figures(silver: DataFrame, hours: int = 24, as_of=None, r: Roles = ROLES) -> DataFrame:
    """What the checks of the last hours need, per key, from one scan."""
    extreme = _is_extreme(r)
    per_key = (
        since_hours(silver, hours, as_of, r.time)
        .groupBy(r.key)
        .agg(
            F.avg("quality_checks_passed").alias("score"),
            F.count(F.lit(1)).alias("records"),
            F.min(r.time).alias("_first"),
            F.max(r.time).alias("_last"),
            F.count_if(extreme).alias("extremes"),
            F.max(F.when(extreme, F.col(r.temperature))).alias("extreme_temp"),
            F.max(F.when(extreme, F.col(r.wind))).alias("extreme_wind"),
        )
        .withColumn("span", boundaries("HOUR", F.col("_first"), F.col("_last")))
    )
    # nothing is missing where the readings span no hour
    missing = F.when(F.col("span") > 0, 1 - F.col("records") / F.col("span")).otherwise(F.lit(0.0))
    return per_key.withColumn("missing", missing).drop("_first", "_last")


def _score_check(r: Roles) -> list[Column]:
    score, text = F.col("score"), F.concat(F.lit("Average quality score for "), F.col(r.key))
    return _check("quality_", score, F.lit(5), rules.score_severity(score), text, r)


def _volume_check(r: Roles) -> list[Column]:
    text = F.format_string("Data volume for %s (missing %s%%)", F.col(r.key), fixed_point(F.col("missing") * 100, 1))
    severity = rules.volume_severity(F.col("missing"))
    return _check("volume_", F.col("records"), F.col("span"), severity, text, r)


def _extreme_check(r: Roles) -> list[Column]:
    text = F.format_string(
        "Extreme events in %s: max temp %s°C, max wind %s km/h",
        F.col(r.key),
        fixed_point(F.col("extreme_temp"), 1),
        fixed_point(F.col("extreme_wind"), 1),
    )
    return _check("extreme_", F.col("extremes"), F.lit(0), F.lit("warning"), text, r)


def score_check(silver: DataFrame, hours: int = 24, as_of=None, r: Roles = ROLES) -> DataFrame:
    return recent_figures(silver, hours, as_of, r).select(*_score_check(r))


def volume_check(silver: DataFrame, hours: int = 24, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Readings against the hours they span."""
    return recent_figures(silver, hours, as_of, r).select(*_volume_check(r), F.col("missing").alias("missing_ratio"))


def extreme_check(silver: DataFrame, hours: int = 24, as_of=None, r: Roles = ROLES) -> DataFrame:
    figures = recent_figures(silver.filter(_is_extreme(r)), hours, as_of, r)
    return figures.select(*_extreme_check(r))


def all_checks(silver: DataFrame, as_of=None, r: Roles = ROLES) -> DataFrame:
    """All four checks in long form: one scan for freshness, one of the last day for the others."""
    kinds = F.array(F.struct(*_score_check(r)), F.struct(*_volume_check(r)), F.struct(*_extreme_check(r)))
    recent = recent_figures(silver, as_of=as_of, r=r).select("extremes", F.inline(kinds))
    found = recent.filter((F.col("extremes") > 0) | ~F.col("name").startswith("extreme_")).drop("extremes")
    return freshness_check(silver, as_of, r).unionByName(found)


def check_summary(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        *[F.count_if(F.col("severity") == s).alias(f"{s}_alerts") for s in ("critical", "warning", "info")],
    )


# ---------------------------------------------------------------- singular data tests


def humidity_range(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    return rows.filter((F.col(r.humidity) < 0) | (F.col(r.humidity) > 100)).select(r.key, r.time, r.humidity)


def temperature_range(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    return rows.filter((F.col(r.temperature) < -50) | (F.col(r.temperature) > 60)).select(
        r.key, r.time, r.temperature
    )


def duplicate_readings(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    return unique_combination(rows, [r.key, r.time], "duplicate_count")


def jumps(rows: DataFrame, threshold: float = 15, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Readings that differ too much from the one before."""
    kept = since_days(rows, days, as_of, r.time).select(r.key, r.time, r.temperature)
    near = neighbour(kept, [r.key], [r.time], {"prev_temp": r.temperature})
    return (
        near.withColumn("temp_change", F.abs(F.col(r.temperature) - F.col("prev_temp")))
        .filter(F.col("temp_change") > threshold)
        .orderBy(F.desc("temp_change"))
    )


def seasonal_anomalies(rows: DataFrame, days: int = 90, as_of=None, r: Roles = ROLES) -> DataFrame:
    rule = rules.season_anomaly(F.col("month"), F.col("avg_temp"))
    return (
        seasonal_profile(rows, days, as_of, r)
        .withColumn("seasonal_anomaly", rule)
        .filter("seasonal_anomaly <> 'Normal Season'")
    )


def key_coverage(rows: DataFrame, hours: int = 24, as_of=None, r: Roles = ROLES) -> DataFrame:
    return (
        since_hours(rows, hours, as_of, r.time)
        .groupBy(r.key)
        .agg(F.count(F.lit(1)).alias("reading_count"), F.max(r.time).alias("latest_reading"))
    )


def poor_coverage(
    rows: DataFrame, hours: int = 24, as_of=None, expected: DataFrame | None = None, r: Roles = ROLES
) -> DataFrame:
    """Keys with few readings; with a list of expected keys also those with none."""
    found = key_coverage(rows, hours, as_of, r)
    if expected is not None:
        found = expected.select(r.key).distinct().join(found, r.key, "left").fillna(0, ["reading_count"])
    return (
        found.withColumn("coverage_status", rules.coverage(F.col("reading_count")))
        .filter("reading_count < 12")
        .orderBy("reading_count")
    )


def gold_validation(daily: DataFrame, events: DataFrame, days: int = 7, as_of=None) -> dict[str, DataFrame]:
    return {
        "missing": missing_measures(daily, days, as_of),
        "freshness": freshness_days(daily, as_of),
        "events": event_counts(events),
    }


def silver_validation(silver: DataFrame) -> dict[str, DataFrame]:
    return {
        "statistics": quality_statistics(silver),
        "invalid": invalid_profile(silver),
        "trend": quality_trend(silver),
    }


