"""Daily summaries, trends and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import rules
from gaugeflow.operators.grouping import latest_per, summarise, value_counts
from gaugeflow.operators.ordered import Size, group_size, neighbour, rolling_range, rolling_rows, time_size
from gaugeflow.spec import ROLES, Roles, since_days, since_hours

DAY = 86_400


def with_date(rows: DataFrame, name: str = "observation_date", r: Roles = ROLES) -> DataFrame:
    return rows.withColumn(name, F.to_date(r.time))


def daily_summary(rows: DataFrame, updated: Column | None = None, r: Roles = ROLES) -> DataFrame:
    """One row per key and date, with the class of the average temperature."""
    days = summarise(
        with_date(rows, r=r),
        [r.key, "observation_date"],
        averages={"avg_temperature": r.temperature, "avg_humidity": r.humidity, "avg_wind_speed": r.wind},
        maxima={"max_temperature": r.temperature},
        minima={"min_temperature": r.temperature},
        modes={"most_common_weather": r.category},
    )
    return days.withColumns(
        {
            "temp_category": rules.temperature_class(F.col("avg_temperature")),
            "last_updated": updated if updated is not None else F.current_timestamp(),
        }
    )


def daily_conditions(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """The categories of each key and date with their number of readings.

    The long form of a list per day: the same content, whatever a day holds.
    """
    return value_counts(with_date(rows, r=r), [r.key, "observation_date"], r.category)


def daily_weather_types(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Per key and date the list of its categories with their numbers of readings, as JSON text, by name.

    Readings are counted first, so a list is as long as the vocabulary of categories.
    """
    entry = F.struct(F.col(r.category).alias("weather"), F.col("occurrence_count").alias("count"))
    listed = daily_conditions(rows, r).groupBy(r.key, "observation_date")
    return listed.agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("weather_types"))


def daily_view(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    return summarise(
        with_date(rows, r=r),
        [r.key, "observation_date"],
        averages={"avg_temperature": r.temperature, "avg_humidity": r.humidity, "avg_wind_speed": r.wind},
        maxima={"max_temperature": r.temperature},
        minima={"min_temperature": r.temperature},
    )


def key_summary(rows: DataFrame, key: str, r: Roles = ROLES) -> DataFrame:
    """Daily view of one key, newest first. The filter reaches the scan."""
    return daily_view(rows.filter(F.col(r.key) == F.lit(key)), r).orderBy(F.desc("observation_date"))


def changes(rows: DataFrame, size: Size | None = None, r: Roles = ROLES) -> DataFrame:
    """Previous reading of the key and the change from it."""
    near = neighbour(rows, [r.key], [r.time], {"prev_temp": r.temperature}, size=size)
    return near.withColumn("temp_change", F.col(r.temperature) - F.col("prev_temp"))


def change_percent(value: Column, previous: Column) -> Column:
    """Change in percent; 0 if the previous value is 0 or absent."""
    return F.when(previous != 0, (value - previous) / previous * 100).otherwise(F.lit(0.0))


def trends(rows: DataFrame, updated: Column | None = None, r: Roles = ROLES) -> DataFrame:
    """Averages over the last 24 hours and 7 days, change and direction, per reading."""
    rows = rows.select(r.key, r.time, r.temperature)
    size = time_size(rows, [r.key], r.time, 7 * DAY)
    rolled = rolling_range(
        rows,
        [r.key],
        r.time,
        {
            "rolling_24h_avg_temp": ("avg", r.temperature, DAY),
            "rolling_7d_avg_temp": ("avg", r.temperature, 7 * DAY),
        },
        size,
    )
    moved = changes(rolled, size, r)
    return moved.select(
        r.key,
        r.time,
        r.temperature,
        "rolling_24h_avg_temp",
        "rolling_7d_avg_temp",
        F.col("temp_change").alias("temp_change_24h"),
        change_percent(F.col(r.temperature), F.col("prev_temp")).alias("temp_change_pct"),
        rules.trend(F.col("temp_change")).alias("trend_direction"),
        (updated if updated is not None else F.current_timestamp()).alias("last_updated"),
    )


def change_24h(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Change against the oldest reading of the last 24 hours; of several at that time, the smallest value."""
    slim = rows.select(r.key, r.time, r.temperature).withColumn("_first", F.struct(r.time, r.temperature))
    framed = rolling_range(slim, [r.key], r.time, {"_from": ("min", "_first", DAY)})
    return (
        framed.withColumn("temp_24h_ago", F.col("_from")[r.temperature])
        .withColumn("temp_change_24h", F.col(r.temperature) - F.col("temp_24h_ago"))
        .drop("_first", "_from")
    )


def trend_view(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Averages over the last 24 and 168 readings, and the change."""
    rows = rows.select(r.key, r.time, r.temperature)
    size = group_size(rows, [r.key])
    rolled = rolling_rows(
        rows,
        [r.key],
        [r.time],
        {"rolling_24h_avg": ("avg", r.temperature, 24), "rolling_7d_avg": ("avg", r.temperature, 168)},
        size,
    )
    return changes(rolled, size, r).drop("prev_temp")


def recent_trends(trend: DataFrame, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    kept = trend.select(
        r.key, r.time, r.temperature, "rolling_24h_avg_temp", "rolling_7d_avg_temp", "trend_direction"
    )
    return since_days(kept, days, as_of, r.time).orderBy(r.key, F.desc(r.time))


def full_moving_averages(rows: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Averages over 24 and 168 readings, NULL until that many are present."""
    rows = rows.select(r.key, r.time, r.temperature)
    frames = {}
    for label, n in (("ma_24h", 24), ("ma_7d", 168)):
        frames[label] = ("avg", r.temperature, n)
        frames[f"_n_{label}"] = ("count", r.temperature, n)
    rolled = rolling_rows(rows, [r.key], [r.time], frames)
    return rolled.withColumns(
        {label: F.when(F.col(f"_n_{label}") == n, F.col(label)) for label, n in (("ma_24h", 24), ("ma_7d", 168))}
    ).drop("_n_ma_24h", "_n_ma_7d")


def detected_events(rows: DataFrame, detected: Column | None = None, r: Roles = ROLES) -> DataFrame:
    """Extreme readings as they are stored."""
    return (
        rows.withColumn("event_type", rules.event_detected(r))
        .filter("event_type IS NOT NULL")
        .select(
            r.key,
            r.time,
            r.temperature,
            r.wind,
            r.category,
            r.description,
            "event_type",
            (detected if detected is not None else F.current_timestamp()).alias("detection_time"),
        )
    )


def listed_events(rows: DataFrame, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Recent heat, wind and rain readings, newest first."""
    extreme = (F.col(r.temperature) > 35) | (F.col(r.wind) > 50) | (F.col(r.category) == "Rain")
    return (
        since_days(rows, days, as_of, r.time)
        .filter(extreme)
        .select(
            r.key,
            r.time,
            r.temperature,
            r.wind,
            r.category,
            r.description,
            rules.event_listed(r).alias("event_type"),
        )
        .orderBy(F.desc(r.time))
    )


def key_alerts(rows: DataFrame, key: str, limit: int = 10, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    """The newest alerts of one key."""
    level = rules.alert_level(r)
    return (
        since_days(rows.filter(F.col(r.key) == F.lit(key)), days, as_of, r.time)
        .withColumn("alert_level", level)
        .filter("alert_level <> 'Normal'")
        .select(r.time, r.temperature, r.wind, r.category, "alert_level")
        .orderBy(F.desc(r.time), F.desc(r.temperature), F.desc(r.wind), r.category)
        .limit(limit)
    )


def event_counts(events: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Stored events per key and type."""
    return (
        events.groupBy(r.key, "event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.min(r.time).alias("first_event"),
            F.max(r.time).alias("last_event"),
        )
        .orderBy(r.key, F.desc("event_count"))
    )


def series(rows: DataFrame, days: int = 7, as_of=None, r: Roles = ROLES) -> DataFrame:
    """Readings of the last days with previous value and change, all keys in one pass."""
    kept = since_days(rows, days, as_of, r.time).select(
        r.key, r.time, r.temperature, r.humidity, r.wind, r.category, r.description
    )
    return changes(kept, r=r).orderBy(r.key, r.time)


def recent_readings(rows: DataFrame, n: int = 20, hours: int = 6, as_of=None, tie: tuple[str, ...] = (), r: Roles = ROLES) -> DataFrame:
    """The newest ``n`` readings of the last hours; sorted and cut per task before they meet."""
    return since_hours(rows, hours, as_of, r.time).orderBy(F.desc(r.time), *tie).limit(n)


def current_conditions(rows: DataFrame, tie: tuple[str, ...] = (), r: Roles = ROLES) -> DataFrame:
    """The newest reading of each key."""
    return latest_per(rows, [r.key], r.time, *tie)


def forecast_days(future: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Daily roll-up of a (predicted) series."""
    return summarise(
        with_date(future, "forecast_date", r),
        [r.key, "forecast_date"],
        count="readings",
        averages={"avg_temperature": r.temperature, "avg_humidity": r.humidity, "avg_wind_speed": r.wind},
        maxima={"max_temperature": r.temperature},
        minima={"min_temperature": r.temperature},
        modes={"typical_weather": r.category},
    )


