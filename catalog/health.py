"""Quality, freshness, volume, checks, metrics, alerts."""

from pyspark.sql import functions as F

from catalog.base import AS_OF, NOW, TODAY, gold, raw, register, silver, table, with_gold, with_raw, with_silver
from gaugeflow.plans import gold as gold_plans
from gaugeflow.plans import health as plans
from gaugeflow.plans import metrics

WEEK = f"observation_time >= {TODAY} - INTERVAL 7 DAY"
DAY = f"observation_time >= {NOW} - INTERVAL 24 HOUR"


@register(
    "quality_statistics",
    with_silver(
        "SELECT city, count(*) AS total_records, count(*) FILTER (WHERE is_valid) AS valid_records, avg(quality_checks_passed) AS avg_quality_score "
        "FROM silver GROUP BY city"
    ),
    "avg_quality_score",
)
def quality_statistics(spark, d):
    return plans.quality_statistics(silver(spark, d))


@register(
    "invalid_profile",
    with_silver("SELECT city, quality_checks_passed, count(*) AS count FROM silver WHERE NOT is_valid GROUP BY 1, 2"),
)
def invalid_profile(spark, d):
    return plans.invalid_profile(silver(spark, d))


@register(
    "quality_trend",
    with_silver(
        "SELECT CAST(observation_time AS DATE) AS date, avg(quality_checks_passed) AS avg_quality_score, count(*) AS record_count FROM silver "
        "GROUP BY 1 ORDER BY 1 DESC LIMIT 7"
    ),
    "avg_quality_score",
)
def quality_trend(spark, d):
    return plans.quality_trend(silver(spark, d))


@register(
    "null_profile",
    with_raw("SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS null_payloads, count(*) - count(source_city) AS null_cities FROM raw"),
)
def null_profile(spark, d):
    return plans.null_profile(raw(spark, d))


@register(
    "duplicate_orderkeys",
    "SELECT ingestion_id, count(*) AS duplicate_count FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS ingestion_id FROM lineitem) AS x "
    "GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_ids(spark, d):
    ids = table(spark, d, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ingestion_id"))
    return plans.duplicate_ids(ids)


@register(
    "load_recency",
    with_raw("SELECT source_city, max(ingestion_time) AS last_ingestion, count(*) AS total_records FROM raw GROUP BY 1"),
)
def load_recency(spark, d):
    return plans.load_recency(raw(spark, d))


DAILY = (
    "daily AS (SELECT city, observation_date, avg(temperature_celsius) AS t, avg(humidity) AS h FROM gold GROUP BY 1, 2)"
)


@register(
    "missing_measures",
    with_gold(
        "SELECT city, count(*) AS total_days, count(*) - count(t) AS missing_temp, count(*) - count(h) AS missing_humidity FROM daily "
        f"WHERE observation_date >= {TODAY} - INTERVAL 7 DAY GROUP BY 1",
        DAILY,
    ),
)
def missing_measures(spark, d):
    return plans.missing_measures(gold_plans.daily_view(gold(spark, d)), 7, AS_OF)


@register(
    "freshness_days",
    with_gold(
        f"SELECT city, max(observation_date) AS latest_data_date, CAST(date_diff('day', max(observation_date), {TODAY}) AS INTEGER) AS days_old FROM gold GROUP BY 1"
    ),
)
def freshness_days(spark, d):
    return plans.freshness_days(gold_plans.daily_view(gold(spark, d)), AS_OF)


@register(
    "freshness_hours",
    with_gold(
        f"SELECT city, max(observation_time) AS latest_time, date_diff('hour', max(observation_time), {NOW}) AS hours_old FROM gold GROUP BY 1"
    ),
)
def freshness_hours(spark, d):
    return plans.freshness(gold(spark, d), as_of=AS_OF)


@register(
    "stale_keys",
    with_gold(
        f"SELECT * FROM (SELECT city, max(observation_time) AS latest_time, date_diff('minute', max(observation_time), {NOW}) AS minutes_since_update "
        "FROM gold GROUP BY 1) AS f WHERE minutes_since_update > 120"
    ),
)
def stale_keys(spark, d):
    return plans.stale_keys(gold(spark, d), as_of=AS_OF)


def complete_sql(key: str = "city") -> str:
    return (
        f"SELECT {key}, count(*) AS days_analyzed, avg(n) AS avg_hourly_readings, min(n) AS min_hourly_readings, max(n) AS max_hourly_readings, "
        "count(*) FILTER (WHERE n >= 20) AS complete_days, count(*) FILTER (WHERE n < 10) AS incomplete_days FROM "
        f"(SELECT {key}, observation_date, count(*) AS n FROM gold WHERE {WEEK} GROUP BY 1, 2) AS c GROUP BY 1"
    )


@register("completeness", with_gold(complete_sql()), "avg_hourly_readings")
def completeness(spark, d):
    return plans.completeness(gold(spark, d), 7, AS_OF)


@register(
    "completeness_by_condition",
    with_gold(
        "SELECT *, round(CAST(complete_days AS DOUBLE) * 100.0 / days_analyzed, 1) AS quality_score, CASE WHEN complete_days >= 5 THEN 'ok' ELSE 'warning' END AS completeness_flag "
        f"FROM ({complete_sql('weather_main')}) AS c"
    ),
    "avg_hourly_readings",
)
def completeness_by_condition(spark, d):
    from dataclasses import replace

    from gaugeflow.spec import ROLES

    complete = plans.completeness(gold(spark, d), 7, AS_OF, replace(ROLES, key="weather_main"))
    return plans.completeness_flag(plans.completeness_score(complete))


@register(
    "volume",
    with_gold(
        f"SELECT city, observation_date AS date, count(*) AS records, count(*) < 19.2 AS is_low FROM gold WHERE {WEEK} GROUP BY 1, 2"
    ),
)
def volume(spark, d):
    return plans.volume(gold(spark, d), 7, as_of=AS_OF)


VALIDATION = (
    "v AS (SELECT city, count(*) AS total_records, count(*) FILTER (WHERE temperature_celsius < -50 OR temperature_celsius > 60) AS temp_outliers, "
    "count(*) FILTER (WHERE humidity < 0 OR humidity > 100) AS humidity_outliers, count(*) FILTER (WHERE wind_speed < 0 OR wind_speed > 150) AS wind_outliers "
    f"FROM silver WHERE {WEEK} GROUP BY city), "
    "validated AS (SELECT *, temp_outliers + humidity_outliers + wind_outliers AS total_outliers, "
    "round(CAST(total_records - (temp_outliers + humidity_outliers + wind_outliers) AS DOUBLE) * 100.0 / total_records, 2) AS validation_rate FROM v)"
)


@register("validation", with_silver("SELECT * FROM validated", VALIDATION))
def validation(spark, d):
    return plans.validation(silver(spark, d), 7, AS_OF)


@register("poor_validation", with_silver("SELECT * FROM validated WHERE validation_rate < 90", VALIDATION))
def poor_validation(spark, d):
    return plans.poor_validation(plans.validation(silver(spark, d), 7, AS_OF))


FRESH = (
    f"fresh AS (SELECT 'freshness_' || city AS name, CAST(h AS DOUBLE) AS value, CAST(4 AS DOUBLE) AS expected, CASE WHEN h > 24 THEN 'critical' WHEN h > 4 THEN 'warning' ELSE 'info' END AS severity, "
    f"'Data freshness for ' || city AS description FROM (SELECT city, date_diff('hour', max(observation_time), {NOW}) AS h FROM silver GROUP BY 1) AS f)"
)
SCORE = (
    "score AS (SELECT 'quality_' || city AS name, s AS value, CAST(5 AS DOUBLE) AS expected, CASE WHEN s < 4 THEN 'critical' WHEN s < 4.5 THEN 'warning' ELSE 'info' END AS severity, "
    f"'Average quality score for ' || city AS description FROM (SELECT city, avg(quality_checks_passed) AS s FROM silver WHERE {DAY} GROUP BY 1) AS f)"
)
VOLUME = (
    "vol AS (SELECT 'volume_' || city AS name, CAST(n AS DOUBLE) AS value, CAST(span AS DOUBLE) AS expected, CASE WHEN missing > 0.5 THEN 'critical' WHEN missing > 0.2 THEN 'warning' ELSE 'info' END AS severity, "
    "printf('Data volume for %s (missing %.1f%%)', city, missing * 100) AS description, missing AS missing_ratio FROM (SELECT *, CASE WHEN span > 0 THEN 1 - CAST(n AS DOUBLE) / span ELSE 0.0 END AS missing FROM "
    f"(SELECT city, count(*) AS n, date_diff('hour', min(observation_time), max(observation_time)) AS span FROM silver WHERE {DAY} GROUP BY 1) AS a) AS f)"
)
EXTREME = (
    "ext AS (SELECT 'extreme_' || city AS name, CAST(n AS DOUBLE) AS value, CAST(0 AS DOUBLE) AS expected, 'warning' AS severity, "
    "printf('Extreme events in %s: max temp %.1f°C, max wind %.1f km/h', city, t, w) AS description FROM "
    f"(SELECT city, count(*) AS n, max(temperature_celsius) AS t, max(wind_speed) AS w FROM silver WHERE {DAY} AND (temperature_celsius > 35 OR temperature_celsius < -10 OR wind_speed > 50) GROUP BY 1) AS f)"
)


@register("freshness_check", with_silver("SELECT * FROM fresh", FRESH))
def freshness_check(spark, d):
    return plans.freshness_check(silver(spark, d), AS_OF)


@register("score_check", with_silver("SELECT * FROM score", SCORE), "value")
def score_check(spark, d):
    return plans.score_check(silver(spark, d), 24, AS_OF)


@register("volume_check", with_silver("SELECT * FROM vol", VOLUME), "missing_ratio")
def volume_check(spark, d):
    return plans.volume_check(silver(spark, d), 24, AS_OF)


@register("extreme_check", with_silver("SELECT * FROM ext", EXTREME))
def extreme_check(spark, d):
    return plans.extreme_check(silver(spark, d), 24, AS_OF)


CHECKS = f"{FRESH}, {SCORE}, {VOLUME}, {EXTREME}, checks AS (SELECT * FROM fresh UNION ALL SELECT * FROM score UNION ALL SELECT * EXCLUDE (missing_ratio) FROM vol UNION ALL SELECT * FROM ext)"
SUMMARY = (
    "SELECT count(*) AS total_checks, count(*) FILTER (WHERE severity = 'critical') AS critical_alerts, "
    "count(*) FILTER (WHERE severity = 'warning') AS warning_alerts, count(*) FILTER (WHERE severity = 'info') AS info_alerts FROM checks"
)


@register("check_summary", with_silver(SUMMARY, CHECKS))
def check_summary(spark, d):
    return plans.check_summary(plans.all_checks(silver(spark, d), AS_OF))


@register(
    "quality_alert",
    with_silver(
        "SELECT printf('Data Quality Report - %d checks', total_checks) AS title, printf('Data quality check completed. Total checks: %d, critical alerts: %d, warning alerts: %d, info alerts: %d', "
        "total_checks, critical_alerts, warning_alerts, info_alerts) AS message, CASE WHEN critical_alerts > 0 THEN 'critical' WHEN warning_alerts > 0 THEN 'warning' ELSE 'info' END AS severity, "
        f"'weather-platform-quality' AS source FROM ({SUMMARY}) AS s",
        CHECKS,
    ),
)
def quality_alert(spark, d):
    return metrics.quality_alert(plans.check_summary(plans.all_checks(silver(spark, d), AS_OF)))


@register(
    "run_alerts",
    with_silver(
        "SELECT pipeline, status, duration_seconds, error, CASE WHEN status = 'failure' THEN 'Pipeline Failed: ' ELSE 'Pipeline Succeeded: ' END || pipeline AS title, "
        "CASE WHEN status = 'failure' THEN printf('Pipeline %s failed after %.2f seconds.', pipeline, duration_seconds) ELSE printf('Pipeline %s completed successfully in %.2f seconds.', pipeline, duration_seconds) END AS message, "
        "CASE WHEN status = 'success' AND error IS NOT NULL THEN 'warning' WHEN status = 'failure' THEN 'critical' ELSE 'info' END AS severity, 'weather-platform-pipeline' AS source FROM r",
        "r AS (SELECT 'load-' || ingestion_id AS pipeline, CASE WHEN is_valid OR humidity < 50 THEN 'success' ELSE 'failure' END AS status, wind_speed AS duration_seconds, "
        "CASE WHEN NOT is_valid THEN 'checks passed: ' || quality_checks_passed END AS error FROM silver)",
    ),
)
def run_alerts(spark, d):
    runs = silver(spark, d).select(
        F.concat(F.lit("load-"), "ingestion_id").alias("pipeline"),
        F.when(F.col("is_valid") | (F.col("humidity") < 50), "success").otherwise("failure").alias("status"),
        F.col("wind_speed").alias("duration_seconds"),
        F.when(~F.col("is_valid"), F.concat(F.lit("checks passed: "), F.col("quality_checks_passed"))).alias("error"),
    )
    return metrics.run_alerts(runs)


@register(
    "threshold_alerts",
    with_gold(
        "SELECT city, event_kind, value, threshold, 'Extreme Weather Alert: ' || city AS title, CASE event_kind WHEN 'heatwave' THEN printf('Temperature of %.1f°C exceeds threshold of %.1f°C', value, threshold) "
        "WHEN 'storm' THEN printf('Wind speed of %.1f km/h exceeds threshold of %.1f km/h', value, threshold) WHEN 'heavy_rain' THEN 'Heavy rain detected in ' || city "
        "ELSE 'Extreme weather event in ' || city END AS message, 'warning' AS severity, 'weather-platform-weather' AS source FROM e",
        "e AS (SELECT city, CASE WHEN temperature_celsius > 35 THEN 'heatwave' WHEN wind_speed > 50 THEN 'storm' WHEN weather_main = 'Rain' THEN 'heavy_rain' ELSE 'fog' END AS event_kind, "
        "CASE WHEN temperature_celsius > 35 THEN temperature_celsius WHEN wind_speed > 50 THEN wind_speed ELSE 1.0 END AS value, "
        "CASE WHEN temperature_celsius > 35 THEN 35.0 WHEN wind_speed > 50 THEN 50.0 ELSE 0.0 END AS threshold FROM gold "
        "WHERE temperature_celsius > 35 OR wind_speed > 50 OR weather_main IN ('Rain', 'Mist'))",
    ),
    "value threshold",
)
def threshold_alerts(spark, d):
    hot, windy = F.col("temperature_celsius") > 35, F.col("wind_speed") > 50
    events = (
        gold(spark, d)
        .filter(hot | windy | F.col("weather_main").isin("Rain", "Mist"))
        .select(
            "city",
            F.when(hot, "heatwave")
            .when(windy, "storm")
            .when(F.col("weather_main") == "Rain", "heavy_rain")
            .otherwise("fog")
            .alias("event_kind"),
            F.when(hot, F.col("temperature_celsius"))
            .when(windy, F.col("wind_speed"))
            .otherwise(1.0)
            .alias("value"),
            F.when(hot, 35.0).when(windy, 50.0).otherwise(0.0).alias("threshold"),
        )
    )
    return metrics.threshold_alerts(events)


# ---------------------------------------------------------------- metric points


def point_sql(name: str, value: str, unit: str, source: str) -> str:
    return f"SELECT '{name}' AS name, CAST({value} AS DOUBLE) AS value, {NOW} AS timestamp, '{unit}' AS unit FROM {source}"


def without_tags(points):
    return points.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).drop("tags")


LOADS = f"loads AS (SELECT count(*) AS n, max(ingestion_time) AS last FROM raw WHERE ingestion_time >= {NOW} - INTERVAL 24 HOUR)"
DONE = (
    "done AS (SELECT count(*) AS n, avg((temperature_celsius BETWEEN -50 AND 60)::INT + (humidity BETWEEN 0 AND 100)::INT + (pressure BETWEEN 800 AND 1100)::INT "
    f"+ (wind_speed BETWEEN 0 AND 150)::INT + 1) AS s FROM obs WHERE processed_time >= {NOW} - INTERVAL 24 HOUR)"
)


@register(
    "pipeline_metrics",
    with_raw(
        " UNION ALL ".join(
            [
                point_sql("ingestion.total_records_24h", "n", "records", "loads"),
                point_sql("ingestion.hours_since_last", f"date_diff('microsecond', last, {NOW}) / 3600000000.0", "hours", "loads"),
                point_sql("silver.total_records_24h", "n", "records", "done"),
                point_sql("silver.avg_quality_score", "s", "score", "done"),
            ]
        ),
        f"{LOADS}, {DONE}",
    ),
    "value",
)
def pipeline_metrics(spark, d):
    return without_tags(metrics.pipeline_metrics(raw(spark, d), silver(spark, d), 24, AS_OF))


WEATHER = f"w AS (SELECT avg(a) AS a, max(hi) AS hi, min(lo) AS lo FROM (SELECT city, avg(temperature_celsius) AS a, max(temperature_celsius) AS hi, min(temperature_celsius) AS lo FROM silver WHERE {DAY} GROUP BY 1) AS k)"
QUALITY = f"q AS (SELECT count(*) AS n, count(*) FILTER (WHERE is_valid) AS v, avg(quality_checks_passed) AS s FROM silver WHERE {DAY})"
WEATHER_POINTS = " UNION ALL ".join(
    point_sql(f"weather.global_{k}_temp", c, "celsius", "w") for k, c in (("avg", "a"), ("max", "hi"), ("min", "lo"))
)
QUALITY_POINTS = " UNION ALL ".join(
    point_sql(f"quality.{k}", c, u, "q")
    for k, c, u in (
        ("total_records", "n", "records"),
        ("valid_records", "v", "records"),
        ("valid_ratio", "CAST(v AS DOUBLE) * 100.0 / n", "percent"),
        ("avg_score", "coalesce(s, 0)", "score"),
    )
)


@register(
    "weather_metrics",
    with_silver(f"SELECT name, value, timestamp, unit, '24h' AS period FROM ({WEATHER_POINTS}) AS p", WEATHER),
    "value",
)
def weather_metrics(spark, d):
    from gaugeflow.sources.storage import flat_tags

    points = metrics.weather_metrics(silver(spark, d), 24, AS_OF)
    return flat_tags(points.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), ["period"])


@register("quality_metrics", with_silver(QUALITY_POINTS, QUALITY), "value")
def quality_metrics(spark, d):
    return without_tags(metrics.quality_metrics(silver(spark, d), 24, AS_OF))


def series(spark, d):
    """Every reading as a metric point of its condition."""
    return silver(spark, d).select(
        F.concat(F.lit("temperature."), "weather_main").alias("name"),
        F.col("temperature_celsius").alias("value"),
        F.col("observation_time").alias("timestamp"),
        F.create_map(F.lit("city"), "city").alias("tags"),
        F.lit("celsius").alias("unit"),
    )


@register(
    "metric_summary",
    with_silver(
        "SELECT 'temperature.' || weather_main AS name, arg_max(temperature_celsius, observation_time) AS current, min(temperature_celsius) AS min, "
        "max(temperature_celsius) AS max, avg(temperature_celsius) AS avg, count(*) AS count, 'celsius' AS unit FROM silver GROUP BY 1"
    ),
    "avg",
)
def metric_summary(spark, d):
    return metrics.metric_summary(series(spark, d))


@register(
    "metric_history",
    with_silver(
        f"SELECT 'temperature.Rain' AS name, temperature_celsius AS value, observation_time AS timestamp, city, 'celsius' AS unit FROM silver WHERE weather_main = 'Rain' AND {DAY}"
    ),
)
def metric_history(spark, d):
    from gaugeflow.sources.storage import flat_tags

    return flat_tags(metrics.metric_history(series(spark, d), "temperature.Rain", 24, AS_OF), ["city"])


@register(
    "key_coverage",
    with_gold(f"SELECT city, count(*) AS reading_count, max(observation_time) AS latest_reading FROM gold WHERE {DAY} GROUP BY 1"),
)
def key_coverage(spark, d):
    return plans.key_coverage(gold(spark, d), 24, AS_OF)
