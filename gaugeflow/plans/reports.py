"""Analytic reports over valid readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import rules
from gaugeflow.functions.scalars import percentage, z_score
from gaugeflow.functions.times import boundaries
from gaugeflow.operators.grouping import join_groups, most_common, share_of_group, summarise, value_counts
from gaugeflow.operators.ordered import SMALL, neighbour, rolling_rows
from gaugeflow.plans.gold import with_date
from gaugeflow.spec import ROLES, Roles, anchor, since_days


def key_overview(rows: DataFrame, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    return summarise(
        since_days(rows, days, as_of, r.time),
        [r.key],
        count="total_readings",
        averages={"avg_temp": r.temperature, "avg_humidity": r.humidity, "avg_wind_speed": r.wind},
        minima={"min_temp": r.temperature},
        maxima={"max_temp": r.temperature, "last_update": r.time},
    ).orderBy(F.desc("avg_temp"))


def daily_trend(rows: DataFrame, days: int = 30, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Daily temperatures with averages over 7 and 30 daily rows."""
    daily = summarise(
        with_date(since_days(rows, days, as_of, r.time), r=r),
        [r.key, "observation_date"],
        count="reading_count",
        averages={"avg_temp": r.temperature},
        minima={"min_temp": r.temperature},
        maxima={"max_temp": r.temperature},
    )
    return rolling_rows(
        daily,
        [r.key],
        ["observation_date"],
        {"rolling_7d_avg": ("avg", "avg_temp", 7), "rolling_30d_avg": ("avg", "avg_temp", 30)},
        SMALL,  # a key has one row per date of the look-back
    ).orderBy(r.key, F.desc("observation_date"))


def key_comparison(rows: DataFrame, days: int = 30, as_of=None, r: Roles = ROLES) -> DataFrame:
    compared = summarise(
        since_days(rows, days, as_of, r.time),
        [r.key],
        averages={"avg_temp": r.temperature, "avg_humidity": r.humidity, "avg_wind": r.wind},
        minima={"_first": r.time},
        maxima={"_last": r.time},
        modes={"most_common_weather": r.category},
        days={"active_days": r.time},
    )
    return (
        compared.withColumn("data_span_days", F.datediff("_last", "_first"))
        .drop("_first", "_last", "record_count")
        .orderBy(F.desc("avg_temp"))
    )


def daily_comparison(daily: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Comparison of keys over their daily rows."""
    return daily.groupBy(r.key).agg(
        F.avg("avg_temperature").alias("avg_temperature"),
        F.avg("avg_humidity").alias("avg_humidity"),
        F.avg("record_count").alias("avg_daily_records"),
        # daily rows are one per date
        F.count("observation_date").alias("days_of_data"),
    )


def category_distribution(rows: DataFrame, days: int | None = 30, as_of=None, r: Roles = ROLES) -> DataFrame:
    source = rows if days is None else since_days(rows, days, as_of, r.time)
    counts = value_counts(source, [r.key], r.category)
    return share_of_group(counts, [r.key], "occurrence_count").orderBy(r.key, F.desc("occurrence_count"))


def category_counts(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    return value_counts(rows, [], r.category, "count").orderBy(F.desc("count"), r.category)


def event_report(rows: DataFrame, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    return (
        since_days(rows, days, as_of, r.time)
        .withColumn("event_type", rules.event_reported(r))
        .filter("event_type <> 'Normal'")
        .groupBy(r.key, "event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.min(r.time).alias("first_event"),
            F.max(r.time).alias("last_event"),
            F.avg(r.temperature).alias("avg_temp_during_events"),
        )
        .orderBy(F.desc("event_count"))
    )


def data_health(rows: DataFrame, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Days and readings of the last days, age of the newest reading, and a status, per key.

    Recent and all-time figures come from one scan: dates before the look-back
    count only for freshness.
    """
    now = anchor(as_of, rows, r.time)
    since = F.date_sub(F.to_date(now), days)
    by_date = (
        with_date(rows.select(r.key, r.time), r=r)
        .groupBy(r.key, "observation_date")
        .agg(F.count(F.lit(1)).alias("n"), F.max(r.time).alias("newest"))
    )
    recent = F.when(F.col("observation_date") >= since, F.col("n"))
    per_key = (
        by_date.groupBy(r.key)
        .agg(
            F.count(recent).alias("days_with_data"),
            F.avg(recent).alias("avg_hourly_readings"),
            F.min(recent).alias("min_hourly_readings"),
            F.max(recent).alias("max_hourly_readings"),
            F.max("newest").alias("latest_update"),
        )
        .filter("days_with_data > 0")
    )
    hours = boundaries("HOUR", F.col("latest_update"), now)
    return (
        per_key.withColumn("hours_since_update", hours)
        .withColumn("data_health_status", rules.data_health(F.col("hours_since_update"), F.col("days_with_data")))
        .orderBy(F.desc("data_health_status"))
    )


def hourly_pattern(rows: DataFrame, days: int = 30, as_of=None, r: Roles = ROLES) -> DataFrame:
    return summarise(
        since_days(rows, days, as_of, r.time).withColumn("hour_of_day", F.hour(r.time)),
        [r.key, "hour_of_day"],
        count="readings",
        averages={"avg_temp": r.temperature, "avg_humidity": r.humidity, "avg_wind": r.wind},
        modes={"typical_weather": r.category},
    ).orderBy(r.key, "hour_of_day")


def key_deviation(rows: DataFrame, days: int = 30, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Mean and sample deviation per key."""
    return (
        since_days(rows, days, as_of, r.time)
        .groupBy(r.key)
        .agg(
            F.avg(r.temperature).alias("city_avg_temp"),
            F.stddev_samp(r.temperature).alias("city_std_temp"),
        )
    )


def anomalies(rows: DataFrame, days: int = 30, recent_days: int = 1, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Recent readings more than one deviation away from the mean of their key."""
    recent = since_days(rows, recent_days, as_of, r.time).select(r.key, r.time, r.temperature)
    scored = join_groups(recent, key_deviation(rows, days, as_of, r), [r.key]).withColumn(
        "z_score", z_score(F.col(r.temperature), F.col("city_avg_temp"), F.col("city_std_temp"))
    )
    return (
        scored.filter(F.abs("z_score") > 1)
        .select(
            r.key,
            r.time,
            r.temperature,
            "city_avg_temp",
            "z_score",
            rules.anomaly(F.col("z_score")).alias("anomaly_status"),
        )
        .orderBy(F.desc(F.abs("z_score")))
    )


def transitions(rows: DataFrame, days: int = 30, as_of=None, r: Roles = ROLES) -> DataFrame:
    """How often the category changes from one reading to the next, per key.

    Pairs are counted first, so the most common one needs no list of all.
    """
    kept = since_days(rows, days, as_of, r.time).select(r.key, r.time, r.category)
    pairs = (
        neighbour(kept, [r.key], [r.time], {"_before": r.category})
        .filter("_before IS NOT NULL")
        .groupBy(r.key, "_before", r.category)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumns(
            {
                "_changed": F.when(F.col("_before") != F.col(r.category), F.col("n")).otherwise(F.lit(0)),
                "_pair": F.concat("_before", F.lit("→"), r.category),
            }
        )
    )
    return (
        pairs.groupBy(r.key)
        .agg(
            F.sum("n").alias("total_readings"),
            F.sum("_changed").alias("weather_changes"),
            most_common("n", "_pair").alias("most_common_transition"),
        )
        .withColumn("change_percentage", percentage(F.col("weather_changes"), F.col("total_readings")))
        .orderBy(F.desc("change_percentage"))
    )


def global_dashboard(rows: DataFrame, days: int = 1, as_of=None, r: Roles = ROLES) -> DataFrame:
    """One line over the per-key figures of the last days."""
    per_key = summarise(
        since_days(rows, days, as_of, r.time),
        [r.key],
        count="reading_count",
        averages={"avg_temp": r.temperature, "avg_humidity": r.humidity},
        minima={"min_temp": r.temperature},
        maxima={"max_temp": r.temperature, "last_updated": r.time},
        modes={"typical_weather": r.category},
    )
    # per category first: the mode of modes is then a minimum over few rows
    parts = per_key.groupBy("typical_weather").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("avg_temp").alias("t"),
        F.count("avg_temp").alias("tn"),
        F.sum("avg_humidity").alias("h"),
        F.count("avg_humidity").alias("hn"),
        F.max("max_temp").alias("hi"),
        F.min("min_temp").alias("lo"),
        F.sum("reading_count").alias("readings"),
        F.max("last_updated").alias("last"),
    )
    return parts.agg(
        F.lit("Global Summary").alias("summary_type"),
        F.sum("n").alias("active_cities"),
        F.try_divide(F.sum("t"), F.sum("tn")).alias("global_avg_temp"),
        F.max("hi").alias("global_max_temp"),
        F.min("lo").alias("global_min_temp"),
        F.try_divide(F.sum("h"), F.sum("hn")).alias("global_avg_humidity"),
        F.sum("readings").alias("total_readings"),
        most_common("n", "typical_weather").alias("global_most_common_weather"),
        F.max("last").alias("latest_update"),
    )


def key_kpis(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    return summarise(
        rows,
        [r.key],
        count="total_readings",
        averages={"avg_temp": r.temperature},
        minima={"min_temp": r.temperature},
        maxima={"max_temp": r.temperature, "last_updated": r.time},
        days={"days_of_data": r.time},
    )


def global_kpis(kpis: DataFrame, r: Roles = ROLES) -> DataFrame:
    """One line over the per-key figures, with the hottest and coldest key."""
    hot = F.max_by(F.struct(r.key, "avg_temp"), F.struct("avg_temp", r.key))
    cold = F.min_by(F.struct(r.key, "avg_temp"), F.struct("avg_temp", r.key))
    return kpis.agg(
        F.avg("avg_temp").alias("global_avg_temp"),
        F.max("max_temp").alias("global_max_temp"),
        F.min("min_temp").alias("global_min_temp"),
        F.count(r.key).alias("total_cities"),
        F.sum("total_readings").alias("total_records"),
        hot[r.key].alias("hottest_city"),
        hot["avg_temp"].alias("hottest_temp"),
        cold[r.key].alias("coldest_city"),
        cold["avg_temp"].alias("coldest_temp"),
    )


def extreme_key(kpis: DataFrame, hottest: bool = True, r: Roles = ROLES) -> DataFrame:
    """The key of the greatest (or smallest) average; ties by name."""
    order = F.desc("avg_temp") if hottest else F.asc("avg_temp")
    return kpis.select(r.key, "avg_temp").orderBy(order, r.key).limit(1)


def describe_keys(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Rounded descriptive figures per key."""
    return rows.groupBy(r.key).agg(
        F.round(F.avg(r.temperature), 1).alias("average"),
        F.round(F.max(r.temperature), 1).alias("max"),
        F.round(F.min(r.temperature), 1).alias("min"),
        F.round(F.stddev_samp(r.temperature), 2).alias("std_dev"),
        F.round(F.avg(r.humidity), 1).alias("average_humidity"),
        F.round(F.avg(r.wind), 1).alias("average_wind_speed"),
        F.count(F.lit(1)).alias("total_records"),
        F.date_format(F.min(r.time), "yyyy-MM-dd").alias("from_date"),
        F.date_format(F.max(r.time), "yyyy-MM-dd").alias("to_date"),
    )


def seasonal_profile(rows: DataFrame, days: int = 90, as_of=None, r: Roles = ROLES) -> DataFrame:
    return summarise(
        since_days(rows, days, as_of, r.time).withColumn("month", F.month(r.time)),
        [r.key, "month"],
        count="sample_size",
        averages={"avg_temp": r.temperature, "avg_humidity": r.humidity},
    )


def dataset_statistics(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """One line: rows, keys, earliest and latest. Keys are counted as groups."""
    return key_statistics(rows, r).agg(
        F.sum("record_count").alias("total_records"),
        F.count(r.key).alias("total_cities"),
        F.min("first_record").alias("earliest_record"),
        F.max("last_record").alias("latest_record"),
    )


def key_statistics(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    return summarise(
        rows,
        [r.key],
        averages={"avg_temp": r.temperature},
        minima={"first_record": r.time},
        maxima={"last_record": r.time},
    ).orderBy(F.desc("record_count"), r.key)
