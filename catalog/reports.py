"""The analytic reports."""

from pyspark.sql import functions as F

from catalog.base import AS_OF, NOW, TODAY, gold, mode_sql, now, register, with_gold
from gaugeflow.plans import gold as gold_plans
from gaugeflow.plans import reports as plans

MONTH = f"observation_time >= {TODAY} - INTERVAL 30 DAY"
WEEK = f"observation_time >= {TODAY} - INTERVAL 7 DAY"
DAY = f"observation_time >= {TODAY} - INTERVAL 1 DAY"


@register(
    "key_overview",
    with_gold(
        "SELECT city, count(*) AS total_readings, avg(temperature_celsius) AS avg_temp, min(temperature_celsius) AS min_temp, "
        "max(temperature_celsius) AS max_temp, avg(humidity) AS avg_humidity, avg(wind_speed) AS avg_wind_speed, "
        f"max(observation_time) AS last_update FROM gold WHERE {WEEK} GROUP BY city"
    ),
    "avg_temp avg_humidity avg_wind_speed",
)
def key_overview(spark, d):
    return plans.key_overview(gold(spark, d), 7, AS_OF)


@register(
    "key_comparison",
    with_gold(
        "SELECT s.*, m.most_common_weather FROM (SELECT city, avg(temperature_celsius) AS avg_temp, avg(humidity) AS avg_humidity, "
        "avg(wind_speed) AS avg_wind, count(DISTINCT observation_date) AS active_days, "
        f"date_diff('day', min(observation_time), max(observation_time)) AS data_span_days FROM gold WHERE {MONTH} GROUP BY city) AS s "
        f"JOIN ({mode_sql('gold', 'city', 'weather_main', 'most_common_weather', MONTH)}) AS m USING (city)"
    ),
    "avg_temp avg_humidity avg_wind",
    "data_span_days active_days",
)
def key_comparison(spark, d):
    return plans.key_comparison(gold(spark, d), 30, AS_OF)


@register(
    "daily_comparison",
    with_gold(
        "SELECT city, avg(t) AS avg_temperature, avg(h) AS avg_humidity, avg(n) AS avg_daily_records, count(DISTINCT observation_date) AS days_of_data "
        "FROM (SELECT city, observation_date, avg(temperature_celsius) AS t, avg(humidity) AS h, count(*) AS n FROM gold GROUP BY 1, 2) AS d GROUP BY city"
    ),
    "avg_temperature avg_humidity avg_daily_records",
)
def daily_comparison(spark, d):
    return plans.daily_comparison(gold_plans.daily_view(gold(spark, d)))


@register(
    "category_distribution",
    with_gold(
        "SELECT city, weather_main, count(*) AS occurrence_count, "
        "round(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER (PARTITION BY city) AS DOUBLE), 2) AS percentage "
        f"FROM gold WHERE {MONTH} GROUP BY city, weather_main"
    ),
)
def category_distribution(spark, d):
    return plans.category_distribution(gold(spark, d), 30, AS_OF)


@register(
    "category_counts",
    with_gold("SELECT weather_main, count(*) AS count FROM gold GROUP BY weather_main"),
)
def category_counts(spark, d):
    return plans.category_counts(gold(spark, d))


@register(
    "category_counts_week",
    with_gold(f"SELECT city, weather_main, count(*) AS count FROM gold WHERE {WEEK} GROUP BY 1, 2"),
)
def category_counts_week(spark, d):
    from gaugeflow.operators.grouping import value_counts
    from gaugeflow.spec import since_days

    return value_counts(since_days(gold(spark, d), 7, AS_OF), ["city"], "weather_main", "count")


REPORTED = (
    "CASE WHEN temperature_celsius > 35 THEN 'Heatwave' WHEN temperature_celsius < -10 THEN 'Freezing' "
    "WHEN wind_speed > 50 THEN 'Storm' WHEN weather_main = 'Rain' AND humidity > 80 THEN 'Heavy Rain' ELSE 'Normal' END"
)


@register(
    "event_report",
    with_gold(
        "SELECT city, event_type, count(*) AS event_count, min(observation_time) AS first_event, max(observation_time) AS last_event, "
        f"avg(temperature_celsius) AS avg_temp_during_events FROM (SELECT *, {REPORTED} AS event_type FROM gold WHERE {WEEK}) AS e "
        "WHERE event_type <> 'Normal' GROUP BY 1, 2"
    ),
    "avg_temp_during_events",
)
def event_report(spark, d):
    return plans.event_report(gold(spark, d), 7, AS_OF)


@register(
    "data_health",
    with_gold(
        "SELECT *, CASE WHEN hours_since_update > 4 THEN 'Stale' WHEN days_with_data < 7 THEN 'Incomplete' ELSE 'Healthy' END AS data_health_status "
        f"FROM (SELECT city, count(n) FILTER (recent) AS days_with_data, avg(n) FILTER (recent) AS avg_hourly_readings, min(n) FILTER (recent) AS min_hourly_readings, "
        f"max(n) FILTER (recent) AS max_hourly_readings, max(newest) AS latest_update, date_diff('hour', max(newest), {NOW}) AS hours_since_update FROM days GROUP BY city) AS k "
        "WHERE days_with_data > 0",
        f"days AS (SELECT city, observation_date, observation_date >= {TODAY} - 7 AS recent, count(*) AS n, max(observation_time) AS newest FROM gold GROUP BY ALL)",
    ),
    "avg_hourly_readings",
)
def data_health(spark, d):
    return plans.data_health(gold(spark, d), 7, AS_OF)


@register(
    "hourly_pattern",
    with_gold(
        "SELECT s.*, m.typical_weather FROM (SELECT city, hour_of_day, avg(temperature_celsius) AS avg_temp, avg(humidity) AS avg_humidity, "
        f"avg(wind_speed) AS avg_wind, count(*) AS readings FROM h WHERE {MONTH} GROUP BY 1, 2) AS s JOIN "
        f"({mode_sql('h', 'city, hour_of_day', 'weather_main', 'typical_weather', MONTH)}) AS m USING (city, hour_of_day)",
        "h AS (SELECT *, CAST(extract(hour FROM observation_time) AS INTEGER) AS hour_of_day FROM gold)",
    ),
    "avg_temp avg_humidity avg_wind",
    "hour_of_day",
)
def hourly_pattern(spark, d):
    return plans.hourly_pattern(gold(spark, d), 30, AS_OF)


DEVIATION = (
    "dev AS (SELECT city, avg(temperature_celsius) AS city_avg_temp, stddev_samp(temperature_celsius) AS city_std_temp "
    f"FROM gold WHERE {MONTH} GROUP BY city)"
)
Z = "(temperature_celsius - city_avg_temp) / nullif(city_std_temp, 0)"
STATUS = (
    "CASE WHEN z_score > 2 THEN 'Significantly Above Average' WHEN z_score < -2 THEN 'Significantly Below Average' "
    "WHEN z_score > 1 THEN 'Above Average' WHEN z_score < -1 THEN 'Below Average' ELSE 'Normal' END"
)


@register("key_deviation", with_gold("SELECT * FROM dev", DEVIATION), "city_avg_temp city_std_temp")
def key_deviation(spark, d):
    return plans.key_deviation(gold(spark, d), 30, AS_OF)


def anomaly_sql(recent: str) -> str:
    return with_gold(
        f"SELECT city, observation_time, temperature_celsius, city_avg_temp, z_score, {STATUS} AS anomaly_status FROM "
        f"(SELECT g.*, city_avg_temp, {Z} AS z_score FROM gold AS g JOIN dev USING (city) WHERE {recent}) AS z WHERE abs(z_score) > 1",
        DEVIATION,
    )


@register("anomalies", anomaly_sql(DAY), "city_avg_temp z_score")
def anomalies(spark, d):
    return plans.anomalies(gold(spark, d), 30, 1, AS_OF)


@register(
    "transitions",
    with_gold(
        "SELECT s.*, m.most_common_transition FROM (SELECT city, count(*) AS total_readings, sum(CASE WHEN prev <> weather_main THEN 1 ELSE 0 END) AS weather_changes, "
        "round(CAST(sum(CASE WHEN prev <> weather_main THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / count(*), 2) AS change_percentage FROM t GROUP BY city) AS s "
        f"JOIN ({mode_sql('t', 'city', 'pair', 'most_common_transition')}) AS m USING (city)",
        "t AS (SELECT *, prev || '→' || weather_main AS pair FROM (SELECT *, lag(weather_main) OVER (PARTITION BY city ORDER BY observation_time) AS prev "
        f"FROM gold WHERE {MONTH}) AS g WHERE prev IS NOT NULL)",
    ),
    big="weather_changes",
)
def transitions(spark, d):
    return plans.transitions(gold(spark, d), 30, AS_OF)


PER_KEY = (
    "k AS (SELECT s.*, m.typical_weather FROM (SELECT city, avg(temperature_celsius) AS avg_temp, max(temperature_celsius) AS max_temp, "
    "min(temperature_celsius) AS min_temp, avg(humidity) AS avg_humidity, count(*) AS n, max(observation_time) AS last_updated "
    f"FROM gold WHERE {DAY} GROUP BY city) AS s JOIN ({mode_sql('gold', 'city', 'weather_main', 'typical_weather', DAY)}) AS m USING (city))"
)


@register(
    "global_dashboard",
    with_gold(
        "SELECT 'Global Summary' AS summary_type, count(DISTINCT city) AS active_cities, avg(avg_temp) AS global_avg_temp, "
        "max(max_temp) AS global_max_temp, min(min_temp) AS global_min_temp, avg(avg_humidity) AS global_avg_humidity, "
        "sum(n) AS total_readings, (SELECT typical_weather FROM k GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS global_most_common_weather, "
        "max(last_updated) AS latest_update FROM k",
        PER_KEY,
    ),
    "global_avg_temp global_avg_humidity",
    "total_readings active_cities",
)
def global_dashboard(spark, d):
    return plans.global_dashboard(gold(spark, d), 1, AS_OF)


KPIS = (
    "kpi AS (SELECT city, avg(temperature_celsius) AS avg_temp, min(temperature_celsius) AS min_temp, max(temperature_celsius) AS max_temp, "
    "count(*) AS total_readings, max(observation_time) AS last_updated, count(DISTINCT observation_date) AS days_of_data FROM gold GROUP BY city)"
)


@register("key_kpis", with_gold("SELECT * FROM kpi", KPIS), "avg_temp")
def key_kpis(spark, d):
    return plans.key_kpis(gold(spark, d))


@register(
    "global_kpis",
    with_gold(
        "SELECT avg(avg_temp) AS global_avg_temp, max(max_temp) AS global_max_temp, min(min_temp) AS global_min_temp, "
        "count(DISTINCT city) AS total_cities, sum(total_readings) AS total_records, "
        "(SELECT city FROM kpi ORDER BY avg_temp DESC, city DESC LIMIT 1) AS hottest_city, max(avg_temp) AS hottest_temp, "
        "(SELECT city FROM kpi ORDER BY avg_temp, city LIMIT 1) AS coldest_city, min(avg_temp) AS coldest_temp FROM kpi",
        KPIS,
    ),
    "global_avg_temp hottest_temp coldest_temp",
    "total_records",
)
def global_kpis(spark, d):
    return plans.global_kpis(plans.key_kpis(gold(spark, d)))


@register(
    "hottest_key",
    with_gold("SELECT city, avg_temp FROM kpi ORDER BY avg_temp DESC, city LIMIT 1", KPIS),
    "avg_temp",
)
def hottest_key(spark, d):
    return plans.extreme_key(plans.key_kpis(gold(spark, d)))


@register(
    "coldest_key",
    with_gold("SELECT city, avg_temp FROM kpi ORDER BY avg_temp, city LIMIT 1", KPIS),
    "avg_temp",
)
def coldest_key(spark, d):
    return plans.extreme_key(plans.key_kpis(gold(spark, d)), hottest=False)


@register(
    "describe_keys",
    with_gold(
        "SELECT city, round(avg(temperature_celsius), 1) AS average, round(max(temperature_celsius), 1) AS max, round(min(temperature_celsius), 1) AS min, "
        "round(stddev_samp(temperature_celsius), 2) AS std_dev, round(avg(humidity), 1) AS average_humidity, round(avg(wind_speed), 1) AS average_wind_speed, "
        "count(*) AS total_records, strftime(min(observation_time), '%Y-%m-%d') AS from_date, strftime(max(observation_time), '%Y-%m-%d') AS to_date "
        "FROM gold GROUP BY city"
    ),
)
def describe_keys(spark, d):
    return plans.describe_keys(gold(spark, d))


@register(
    "seasonal_profile",
    with_gold(
        "SELECT city, CAST(extract(month FROM observation_time) AS INTEGER) AS month, count(*) AS sample_size, avg(temperature_celsius) AS avg_temp, avg(humidity) AS avg_humidity "
        f"FROM gold WHERE observation_time >= {TODAY} - INTERVAL 90 DAY GROUP BY 1, 2"
    ),
    "avg_temp avg_humidity",
)
def seasonal_profile(spark, d):
    return plans.seasonal_profile(gold(spark, d), 90, AS_OF)


@register(
    "dataset_statistics",
    with_gold(
        "SELECT count(*) AS total_records, count(DISTINCT city) AS total_cities, min(observation_time) AS earliest_record, "
        "max(observation_time) AS latest_record FROM gold"
    ),
)
def dataset_statistics(spark, d):
    return plans.dataset_statistics(gold(spark, d))


@register(
    "key_statistics",
    with_gold(
        "SELECT city, count(*) AS record_count, min(observation_time) AS first_record, max(observation_time) AS last_record, "
        "avg(temperature_celsius) AS avg_temp FROM gold GROUP BY city"
    ),
    "avg_temp",
)
def key_statistics(spark, d):
    return plans.key_statistics(gold(spark, d))


@register(
    "forecast_days",
    with_gold(
        "SELECT s.*, m.typical_weather FROM (SELECT city, observation_date AS forecast_date, count(*) AS readings, avg(temperature_celsius) AS avg_temperature, "
        "max(temperature_celsius) AS max_temperature, min(temperature_celsius) AS min_temperature, avg(humidity) AS avg_humidity, avg(wind_speed) AS avg_wind_speed "
        "FROM gold WHERE observation_time > TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1, 2) AS s JOIN (SELECT city, observation_date AS forecast_date, typical_weather FROM ("
        + mode_sql("gold", "city, observation_date", "weather_main", "typical_weather", "observation_time > TIMESTAMP '2024-01-24 00:00:00'")
        + ") AS x) AS m USING (city, forecast_date)"
    ),
    "avg_temperature avg_humidity avg_wind_speed",
)
def forecast_days(spark, d):
    from gaugeflow.spec import split_at

    _, future = split_at(gold(spark, d), "2024-01-24 00:00:00")
    return gold_plans.forecast_days(future)


@register(
    "hours_since_update",
    with_gold(
        f"SELECT city, date_diff('microsecond', max(observation_time), {NOW}) / 3600000000.0 AS hours_since FROM gold GROUP BY city"
    ),
    "hours_since",
)
def hours_since_update(spark, d):
    from gaugeflow.functions.times import hours_between

    newest = gold(spark, d).groupBy("city").agg(F.max("observation_time").alias("t"))
    return newest.select("city", hours_between(F.col("t"), now()).alias("hours_since"))
