"""Models built on staged readings: per key and date, and per date over all keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions import rules
from gaugeflow.operators.grouping import (
    latest_per,
    most_common,
    share_of_group,
    summarise,
    value_counts,
)
from gaugeflow.operators.ordered import Size, group_size, neighbour, rolling_rows, running
from gaugeflow.plans.gold import with_date
from gaugeflow.spec import ROLES, Roles

RANK_DIGITS = 9


def daily_stats(staged: DataFrame, r: Roles = ROLES) -> DataFrame:
    return summarise(
        with_date(staged, r=r),
        [r.key, "observation_date"],
        count="hourly_readings",
        averages={"avg_temp": r.temperature, "avg_humidity": r.humidity, "avg_wind_speed": r.wind},
        maxima={"max_temp": r.temperature},
        minima={"min_temp": r.temperature},
        modes={"most_common_weather": r.category},
    )


def classified_readings(staged: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Readings with averages over 24 and 168 rows, direction and temperature class."""
    rows = staged.select(r.key, r.time, r.temperature)
    size = group_size(rows, [r.key])
    rolled = rolling_rows(
        rows,
        [r.key],
        [r.time],
        {
            "rolling_24h_avg_temp": ("avg", r.temperature, 24),
            "rolling_7d_avg_temp": ("avg", r.temperature, 168),
        },
        size,
    )
    moved = neighbour(rolled, [r.key], [r.time], {"_prev": r.temperature}, size=size)
    return moved.select(
        r.key,
        r.time,
        F.to_date(r.time).alias("observation_date"),
        "rolling_24h_avg_temp",
        "rolling_7d_avg_temp",
        rules.trend(F.col(r.temperature) - F.col("_prev")).alias("trend_direction"),
        rules.temperature_class(F.col(r.temperature)).alias("temperature_category"),
    )


def key_metrics(staged: DataFrame, grain: str = "reading", r: Roles = ROLES) -> DataFrame:
    """Daily figures next to each reading of the day, or (``grain="day"``) to its last one."""
    readings = classified_readings(staged, r)
    if grain == "day":
        readings = latest_per(readings, [r.key, "observation_date"], r.time)
    elif grain != "reading":
        raise ValueError(f"grain must be 'reading' or 'day', not {grain!r}")
    return _by_day(daily_stats(staged, r), readings, r)


def _by_day(days: DataFrame, readings: DataFrame, r: Roles) -> DataFrame:
    """Every day with its readings; a NULL key or date is one like others."""
    on = [r.key, "observation_date"]
    there = readings.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in readings.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return days.join(there, same, "left").drop(*[f"_r_{c}" for c in on])


def _places(values: DataFrame, keys: list[str], name: str, size: Size) -> DataFrame:
    """Per value of ``_by`` within ``keys``, of which there are ``n`` rows: its rank from the top and its percent rank."""
    upto = running(values, keys, ["_by"], {"upto": ("sum", F.col("n"))}, size)
    whole = values.groupBy(*[F.col(k).alias(f"_w_{k}") for k in keys]).agg(F.sum("n").alias("whole"))
    if keys:
        placed = upto.join(whole, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in keys]))
    else:
        placed = upto.join(F.broadcast(whole), F.lit(True))  # one row
    return placed.select(
        *[F.col(k).alias(f"_{name}_{k}") for k in [*keys, "_by"]],
        (F.col("whole") - F.col("upto") + 1).cast("bigint").alias(f"{name}_rank"),
        F.when(F.col("whole") > 1, (F.col("upto") - F.col("n")) / (F.col("whole") - 1)).otherwise(0.0).alias(f"{name}_percent"),
    )


def ranked_days(days: DataFrame, weight: Column) -> DataFrame:
    """Days with the ranks of their average temperature among all readings, of which a day has ``weight``.

    A day's average is the same for all its readings, so values of days are
    ordered, not readings. Sums of doubles depend on their order, so equal averages
    are made equal before they are ranked.
    """
    days = days.withColumn("_by", F.round("avg_temp", RANK_DIGITS))
    out = days
    per_date = days.groupBy("observation_date", "_by").agg(F.sum(weight).cast("bigint").alias("n"))
    overall = per_date.groupBy("_by").agg(F.sum("n").cast("bigint").alias("n"))
    size = group_size(per_date, ["observation_date"])  # its total bounds the values over all dates
    for values, keys, name, n in ((overall, [], "g", size.whole()), (per_date, ["observation_date"], "d", size)):
        places = _places(values, keys, name, n)
        same = [F.col(k).eqNullSafe(F.col(f"_{name}_{k}")) for k in [*keys, "_by"]]
        out = out.join(places, same, "left").drop(*[f"_{name}_{k}" for k in [*keys, "_by"]])
    named = {"g_rank": "temp_rank_global", "d_rank": "temp_rank_daily", "g_percent": "temp_percentile"}
    return out.withColumnsRenamed(named).drop("_by", "d_percent")


def key_mart(staged: DataFrame, grain: str = "reading", updated: Column | None = None, r: Roles = ROLES) -> DataFrame:
    """Key metrics with deviation, day alert and temperature ranks."""
    readings = classified_readings(staged, r)
    if grain == "day":
        readings = latest_per(readings, [r.key, "observation_date"], r.time)
    elif grain != "reading":
        raise ValueError(f"grain must be 'reading' or 'day', not {grain!r}")
    days = ranked_days(daily_stats(staged, r), F.col("hourly_readings") if grain == "reading" else F.lit(1))
    return _by_day(days, readings, r).withColumns(
        {
            "temp_vs_7d_avg": F.col("avg_temp") - F.col("rolling_7d_avg_temp"),
            "weather_alert": rules.day_alert(
                F.col("avg_temp"), F.col("avg_humidity"), F.col("avg_wind_speed"), F.col("most_common_weather")
            ),
            "last_updated": updated if updated is not None else F.current_timestamp(),
        }
    )


def category_json(staged: DataFrame, r: Roles = ROLES) -> DataFrame:
    """Per date, the categories with counts and percentages as a JSON array, by name.

    The list of a date is as long as the vocabulary of categories.
    """
    counts = value_counts(with_date(staged, r=r), ["observation_date"], r.category, "count")
    entry = F.struct(F.col(r.category).alias("weather"), "count", "percentage")
    return (
        share_of_group(counts, ["observation_date"], "count")
        .groupBy("observation_date")
        .agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("weather_distribution"))
    )


def global_mart(staged: DataFrame, updated: Column | None = None, r: Roles = ROLES) -> DataFrame:
    """One row per date over all keys: averages, extremes, common weather, distribution.

    The key mart repeats a day for each reading, and averages weigh days so: days
    with their numbers of readings say the same. They are grouped by (date,
    category), then by date.
    """
    day = "observation_date"
    days = daily_stats(staged, r).withColumnRenamed("hourly_readings", "n")

    def weighed(c: str) -> list[Column]:
        return [
            F.sum(F.col(c) * F.col("n")).alias(f"{c}_sum"),
            F.sum(F.when(F.col(c).isNotNull(), F.col("n"))).alias(f"{c}_n"),
        ]

    hottest = F.struct((-F.col("avg_temp")).alias("o"), F.col(r.key).alias("k"))
    coldest = F.struct(F.col("avg_temp").alias("o"), F.col(r.key).alias("k"))
    wettest = F.struct((-F.col("avg_humidity")).alias("o"), F.col(r.key).alias("k"))
    by_category = days.groupBy(day, "most_common_weather").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("keys"),
        *weighed("avg_temp"),
        *weighed("avg_humidity"),
        *weighed("avg_wind_speed"),
        F.min(hottest).alias("hot"),
        F.min(coldest).alias("cold"),
        F.min(wettest).alias("wet"),
    )

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n"))

    per_day = by_category.groupBy(day).agg(
        F.sum("keys").alias("active_cities"),
        mean("avg_temp").alias("global_avg_temp"),
        (-F.min("hot")["o"]).alias("global_max_temp"),
        F.min("cold")["o"].alias("global_min_temp"),
        mean("avg_humidity").alias("global_avg_humidity"),
        mean("avg_wind_speed").alias("global_avg_wind_speed"),
        most_common("n", "most_common_weather").alias("global_most_common_weather"),
        F.min("hot")["k"].alias("hottest_city"),
        (-F.min("hot")["o"]).alias("hottest_city_temp"),
        F.min("cold")["k"].alias("coldest_city"),
        F.min("cold")["o"].alias("coldest_city_temp"),
        F.min("wet")["k"].alias("highest_humidity_city"),
        (-F.min("wet")["o"]).alias("highest_humidity_value"),
    )
    shares = category_json(staged, r).withColumnRenamed(day, "_s_date")
    return (
        per_day.join(shares, F.col(day).eqNullSafe(F.col("_s_date")), "left")
        .drop("_s_date")
        .withColumn("last_updated", updated if updated is not None else F.current_timestamp())
        .orderBy(F.desc(day))
    )
