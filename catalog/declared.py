"""Tables declared without a formula."""

from pyspark.sql import functions as F

from catalog.base import AS_OF, NOW, gold, now, register, silver, table, with_gold, with_silver
from catalog.layers import DAILY_VIEW
from catalog.marts import ALL, global_table, staged
from catalog.reports import MONTH, anomaly_sql
from gaugeflow.plans import declared as plans
from gaugeflow.plans import gold as gold_plans
from gaugeflow.runtime import scratch_path
from gaugeflow.sources import snapshots

EVENT_TYPE = (
    "CASE WHEN temperature_celsius > 35 THEN 'Heatwave' WHEN wind_speed > 50 OR weather_main = 'Thunderstorm' THEN 'Storm' "
    "WHEN weather_main = 'Rain' THEN 'Heavy Rain' END"
)


@register(
    "global_mart_extras",
    with_gold(
        "SELECT observation_date, global_avg_temp, global_max_temp, global_min_temp, global_max_temp - global_min_temp AS temp_range, "
        "avg(global_avg_temp) OVER (ORDER BY observation_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS avg_temp_rolling_7d, extreme_event_count "
        f"FROM global LEFT JOIN (SELECT observation_date, count({EVENT_TYPE}) AS extreme_event_count FROM gold GROUP BY 1) AS e USING (observation_date)",
        ALL,
    ),
    "global_avg_temp global_max_temp global_min_temp temp_range avg_temp_rolling_7d",
)
def global_mart_extras(spark, d):
    return plans.global_mart_extras(global_table(spark, d), staged(spark, d))


@register(
    "daily_extras",
    with_gold(
        "SELECT *, max_temperature - min_temperature AS temperature_range, record_count >= 24 AS is_complete_day FROM "
        f"({DAILY_VIEW}) AS v"
    ),
    "avg_temperature avg_humidity avg_wind_speed temperature_range",
)
def daily_extras(spark, d):
    return plans.daily_extras(gold_plans.daily_view(gold(spark, d)))


@register(
    "rolling_extremes",
    with_gold(
        "SELECT city, observation_time, temperature_celsius, "
        "min(temperature_celsius) OVER (PARTITION BY city ORDER BY observation_time RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS rolling_24h_min_temp, "
        "max(temperature_celsius) OVER (PARTITION BY city ORDER BY observation_time RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS rolling_24h_max_temp FROM gold"
    ),
)
def rolling_extremes(spark, d):
    return plans.rolling_extremes(gold(spark, d))


@register(
    "quality_mart",
    with_silver(
        "SELECT *, CASE WHEN quality_score >= 95 THEN 'Excellent' WHEN quality_score >= 85 THEN 'Good' WHEN quality_score >= 70 THEN 'Fair' "
        "WHEN quality_score >= 50 THEN 'Poor' ELSE 'Critical' END AS quality_status FROM (SELECT city, CAST(observation_time AS DATE) AS date, "
        "count(*) AS total_readings, count(*) FILTER (WHERE is_valid) AS valid_readings, count(*) FILTER (WHERE NOT is_valid) AS invalid_readings, "
        "sum(5 - quality_checks_passed) AS issues_detected, CAST(count(*) FILTER (WHERE is_valid) AS DOUBLE) / count(*) * 100.0 AS quality_score, "
        f"least(count(*) / 24.0::DOUBLE, 1.0::DOUBLE) * 100.0 AS data_completeness, date_diff('hour', max(observation_time), {NOW}) AS freshness_hours, "
        f"{NOW} AS last_checked FROM silver GROUP BY 1, 2) AS q"
    ),
    "quality_score data_completeness",
    "issues_detected",
)
def quality_mart(spark, d):
    return plans.quality_mart(silver(spark, d), AS_OF, now())


@register(
    "forecast_accuracy",
    with_gold(
        "SELECT p.city, p.observation_date + 1 AS forecast_date, CAST(24 AS INTEGER) AS forecast_horizon_hours, p.avg_temperature AS predicted_temp, a.avg_temperature AS actual_temp, "
        "abs(p.avg_temperature - a.avg_temperature) AS absolute_error, abs(p.avg_temperature - a.avg_temperature) / nullif(abs(a.avg_temperature), 0) * 100 AS percentage_error, "
        "greatest(0.0, 100 - abs(p.avg_temperature - a.avg_temperature) / nullif(abs(a.avg_temperature), 0) * 100) AS accuracy_score, "
        "abs(p.avg_temperature - a.avg_temperature) / nullif(abs(a.avg_temperature), 0) * 100 <= 10 AS is_accurate "
        "FROM daily AS p JOIN daily AS a ON a.city = p.city AND a.observation_date = p.observation_date + 1",
        f"daily AS ({DAILY_VIEW})",
    ),
    "predicted_temp actual_temp absolute_error percentage_error accuracy_score",
)
def forecast_accuracy(spark, d):
    daily = gold_plans.daily_view(gold(spark, d))
    return plans.forecast_accuracy(plans.persistence_forecast(daily), daily)


@register("anomaly_model", anomaly_sql(MONTH), "city_avg_temp z_score")
def anomaly_model(spark, d):
    return plans.anomaly_model(gold(spark, d), 30, AS_OF)


@register(
    "correlations",
    with_gold(
        "SELECT city, count(*) AS readings, corr(temperature_celsius, humidity) AS temp_humidity, corr(temperature_celsius, pressure) AS temp_pressure, "
        "corr(temperature_celsius, wind_speed) AS temp_wind, corr(humidity, pressure) AS humidity_pressure, corr(humidity, wind_speed) AS humidity_wind, "
        "corr(pressure, wind_speed) AS pressure_wind FROM gold GROUP BY city"
    ),
    "temp_humidity temp_pressure temp_wind humidity_pressure humidity_wind pressure_wind",
)
def correlations(spark, d):
    return plans.correlations(gold(spark, d))


@register(
    "station_metrics",
    with_gold(
        "SELECT city, count(*) AS record_count, min(observation_time) AS first_record, max(observation_time) AS last_record, avg(temperature_celsius) AS avg_temp, "
        "date_diff('hour', min(observation_time), max(observation_time)) + 1 AS hours_covered FROM gold GROUP BY city"
    ),
    "avg_temp",
)
def station_metrics(spark, d):
    return plans.station_metrics(gold(spark, d))


@register(
    "event_episodes",
    with_gold(
        "SELECT city, event_type, count(*) AS readings, min(observation_time) AS started, max(observation_time) AS ended, "
        "date_sub('minute', min(observation_time), max(observation_time)) AS event_duration_minutes FROM "
        "(SELECT *, sum(CASE WHEN event_type IS NOT DISTINCT FROM prev THEN 0 ELSE 1 END) OVER (PARTITION BY city ORDER BY observation_time) AS episode FROM "
        "(SELECT *, lag(event_type) OVER (PARTITION BY city ORDER BY observation_time) AS prev FROM "
        f"(SELECT *, {EVENT_TYPE} AS event_type FROM gold) AS a) AS b) AS c WHERE event_type IS NOT NULL GROUP BY city, event_type, episode"
    ),
)
def event_episodes(spark, d):
    return plans.event_episodes(gold(spark, d))


@register(
    "history",
    "SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM "
    "(SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS p FROM orders) AS o WHERE p = 1",
)
def history(spark, d):
    log = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return plans.history(log, ["o_custkey"], "o_orderdate")


HISTORY = (
    "SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM "
    "(SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS p FROM orders) AS o WHERE p = 1"
)


@register("history_maintained", f"SELECT *, CAST(date_trunc('month', valid_to) AS DATE) AS closed_on FROM ({HISTORY}) AS h")
def history_maintained(spark, d):
    """The history kept over four loads: the latest orders first, then the others in two mixed loads, one of them twice."""
    log = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    path, late = scratch_path(spark, "history"), F.col("o_orderdate") >= F.lit("2000-01-01")
    odd = F.col("o_orderkey") % 2 == 1
    for load in (log.filter(late), log.filter(~late & odd), log.filter(~late & ~odd), log.filter(~late & odd)):
        snapshots.keep_history(load, path, ["o_custkey"], "o_orderdate", "month")
    return snapshots.read(spark, path, log, "o_orderdate")


@register(
    "climate_patterns",
    with_gold(
        "SELECT city, CAST(extract(month FROM observation_time) AS INTEGER) AS month, count(*) AS sample_size, avg(temperature_celsius) AS avg_temp, "
        "avg(humidity) AS avg_humidity FROM gold WHERE observation_time >= DATE '2024-01-31' - INTERVAL 365 DAY GROUP BY 1, 2"
    ),
    "avg_temp avg_humidity",
)
def climate_patterns(spark, d):
    from gaugeflow.plans.reports import seasonal_profile

    return seasonal_profile(gold(spark, d), 365, AS_OF)
