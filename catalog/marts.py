"""Models per key and date, and per date over all keys."""

from catalog.base import NOW, mode_sql, now, register, silver, with_gold
from catalog.layers import class_sql
from catalog.windows import TREND_CLASS
from gaugeflow.operators.columns import star
from gaugeflow.plans import marts as plans
from gaugeflow.plans import silver as silver_plans
from gaugeflow.runtime import written


def staged(spark, d):
    return silver_plans.staging(silver(spark, d), processed=now())


STATS = (
    "stats AS (SELECT s.*, m.most_common_weather FROM (SELECT city, observation_date, count(*) AS hourly_readings, avg(temperature_celsius) AS avg_temp, "
    "max(temperature_celsius) AS max_temp, min(temperature_celsius) AS min_temp, avg(humidity) AS avg_humidity, avg(wind_speed) AS avg_wind_speed "
    "FROM gold GROUP BY 1, 2) AS s JOIN ("
    + mode_sql("gold", "city, observation_date", "weather_main", "most_common_weather")
    + ") AS m ON s.city IS NOT DISTINCT FROM m.city AND s.observation_date IS NOT DISTINCT FROM m.observation_date)"
)

READINGS = f"""readings AS (
  SELECT city, observation_time, observation_date,
    avg(temperature_celsius) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS rolling_24h_avg_temp,
    avg(temperature_celsius) OVER (w ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS rolling_7d_avg_temp,
    {TREND_CLASS.format(c='temperature_celsius - lag(temperature_celsius) OVER w')} AS trend_direction,
    {class_sql('temperature_celsius')} AS temperature_category
  FROM gold WINDOW w AS (PARTITION BY city ORDER BY observation_time))"""

LAST = (
    "last AS (SELECT * EXCLUDE (p) FROM (SELECT *, row_number() OVER (PARTITION BY city, observation_date ORDER BY observation_time DESC) AS p "
    "FROM readings) AS r WHERE p = 1)"
)


def metrics_sql(source: str) -> str:
    return (
        f"metrics AS (SELECT stats.*, s.* EXCLUDE (city, observation_date) FROM stats LEFT JOIN {source} AS s "
        "ON stats.city IS NOT DISTINCT FROM s.city AND stats.observation_date IS NOT DISTINCT FROM s.observation_date)"
    )


MART = f"""mart AS (
  SELECT *, avg_temp - rolling_7d_avg_temp AS temp_vs_7d_avg,
    CASE WHEN avg_temp > 30 AND avg_humidity > 70 THEN 'High Heat & Humidity' WHEN avg_temp > 30 THEN 'Heatwave Risk'
         WHEN avg_wind_speed > 50 THEN 'High Wind Alert' WHEN most_common_weather = 'Rain' AND avg_humidity > 80 THEN 'Heavy Rain Risk'
         ELSE 'Normal' END AS weather_alert,
    rank() OVER (ORDER BY round(avg_temp, 9) DESC) AS temp_rank_global,
    rank() OVER (PARTITION BY observation_date ORDER BY round(avg_temp, 9) DESC) AS temp_rank_daily,
    percent_rank() OVER (ORDER BY round(avg_temp, 9)) AS temp_percentile, {NOW} AS last_updated
  FROM metrics)"""

METRIC_DOUBLES = "avg_temp avg_humidity avg_wind_speed rolling_24h_avg_temp rolling_7d_avg_temp"
MART_DOUBLES = f"{METRIC_DOUBLES} temp_vs_7d_avg temp_percentile"


@register("daily_stats", with_gold("SELECT * FROM stats", STATS), "avg_temp avg_humidity avg_wind_speed")
def daily_stats(spark, d):
    return plans.daily_stats(staged(spark, d))


@register(
    "classified_readings",
    with_gold("SELECT * FROM readings", READINGS),
    "rolling_24h_avg_temp rolling_7d_avg_temp",
)
def classified_readings(spark, d):
    return plans.classified_readings(staged(spark, d))


@register(
    "key_metrics",
    with_gold("SELECT * FROM metrics", f"{STATS}, {READINGS}, {metrics_sql('readings')}"),
    METRIC_DOUBLES,
)
def key_metrics(spark, d):
    return plans.key_metrics(staged(spark, d))


@register(
    "key_mart",
    with_gold("SELECT * FROM mart", f"{STATS}, {READINGS}, {metrics_sql('readings')}, {MART}"),
    MART_DOUBLES,
    "temp_rank_global temp_rank_daily",
)
def key_mart(spark, d):
    return plans.key_mart(staged(spark, d), updated=now())


@register(
    "key_mart_by_day",
    with_gold("SELECT * FROM mart", f"{STATS}, {READINGS}, {LAST}, {metrics_sql('last')}, {MART}"),
    MART_DOUBLES,
    "temp_rank_global temp_rank_daily",
)
def key_mart_by_day(spark, d):
    return plans.key_mart(staged(spark, d), "day", now())


def first_sql(column: str, order: str) -> str:
    return f"first({column} ORDER BY {order})"


GLOBAL = f"""global AS (
  SELECT g.*, m.global_most_common_weather, w.weather_distribution, {NOW} AS last_updated FROM (
    SELECT observation_date, count(DISTINCT city) AS active_cities, avg(avg_temp) AS global_avg_temp, max(avg_temp) AS global_max_temp,
      min(avg_temp) AS global_min_temp, avg(avg_humidity) AS global_avg_humidity, avg(avg_wind_speed) AS global_avg_wind_speed,
      {first_sql('city', 'avg_temp DESC, city')} AS hottest_city, max(avg_temp) AS hottest_city_temp,
      {first_sql('city', 'avg_temp, city')} AS coldest_city, min(avg_temp) AS coldest_city_temp,
      {first_sql('city', 'avg_humidity DESC, city')} AS highest_humidity_city, max(avg_humidity) AS highest_humidity_value
    FROM mart GROUP BY observation_date) AS g
  JOIN ({mode_sql('mart', 'observation_date', 'most_common_weather', 'global_most_common_weather')}) AS m USING (observation_date)
  LEFT JOIN (SELECT observation_date, CAST(to_json(list(struct_pack(weather := weather_main, count := n, percentage := p) ORDER BY weather_main)) AS VARCHAR) AS weather_distribution
     FROM (SELECT observation_date, weather_main, count(*) AS n,
             round(CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER (PARTITION BY observation_date) AS DOUBLE), 2) AS p
           FROM gold GROUP BY 1, 2) AS c GROUP BY 1) AS w USING (observation_date))"""

ALL = f"{STATS}, {READINGS}, {metrics_sql('readings')}, {MART}, {GLOBAL}"
GLOBAL_DOUBLES = (
    "global_avg_temp global_max_temp global_min_temp global_avg_humidity global_avg_wind_speed hottest_city_temp coldest_city_temp "
    "highest_humidity_value"
)


def global_table(spark, d):
    rows = staged(spark, d)
    return plans.global_mart(rows, now())


@register("global_mart", with_gold("SELECT * FROM global", ALL), GLOBAL_DOUBLES)
def global_mart(spark, d):
    return global_table(spark, d)


@register(
    "category_json",
    with_gold("SELECT observation_date, weather_distribution FROM global", ALL),
)
def category_json(spark, d):
    return plans.category_json(staged(spark, d))


@register(
    "mart_columns",
    with_gold(
        "SELECT city AS mart_city_out, observation_date AS mart_observation_date_out, avg_temp AS mart_avg_temp_out FROM stats", STATS
    ),
    "mart_avg_temp_out",
)
def mart_columns(spark, d):
    return star(
        plans.daily_stats(staged(spark, d)),
        ["HOURLY_READINGS", "max_temp", "min_temp", "avg_humidity", "avg_wind_speed", "most_common_weather"],
        "mart_",
        "_out",
    )


@register(
    "mart_materialised",
    with_gold("SELECT weather_alert, count(*) AS days FROM mart GROUP BY 1", f"{STATS}, {READINGS}, {LAST}, {metrics_sql('last')}, {MART}"),
)
def mart_materialised(spark, d):
    from gaugeflow.runtime import scratch_path
    from gaugeflow.sources import storage

    daily = written(plans.key_mart(staged(spark, d), "day", now()))
    path = scratch_path(spark, "mart")
    for _ in range(2):  # the second run merges into the first
        mart = storage.materialise(
            daily, "mart_city_weather", "incremental", path, ["city", "observation_date"], ["observation_date"]
        )
    return storage.query(
        spark,
        "SELECT weather_alert, count(*) AS days FROM mart_city_weather WHERE hourly_readings >= :least GROUP BY weather_alert",
        {"mart_city_weather": mart},
        least=1,
    )
