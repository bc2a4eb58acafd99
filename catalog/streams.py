"""Streaming queries, run to the end of the given files and read back."""

from pyspark.sql import functions as F

from catalog.base import GOLD, OBS, RAW, now, observed, raw_of, register, table
from catalog.layers import CLEAN, DAILY_VIEW
from gaugeflow.plans import declared, gold
from gaugeflow.plans.silver import score
from gaugeflow.runtime import scratch_path, written
from gaugeflow.streaming import pipelines


def event_stream(spark, d):
    """The events file as a stream."""
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


@register("stream_raw_to_silver", f"WITH {RAW}, {CLEAN} SELECT * FROM clean")
def stream_raw_to_silver(spark, d):
    path = scratch_path(spark, "stream-silver")
    pipelines.raw_to_silver(
        raw_of(observed(event_stream(spark, d))),
        path,
        scratch_path(spark, "stream-state"),
        now(),
        "timestamp_ntz",
    ).awaitTermination()
    return spark.read.parquet(path).drop("ingestion_time", "observation_date")


@register(
    "stream_daily_summary",
    f"WITH {GOLD} SELECT city, observation_date, count(*) AS record_count, avg(temperature_celsius) AS avg_temperature, max(temperature_celsius) AS max_temperature, "
    "min(temperature_celsius) AS min_temperature, avg(humidity) AS avg_humidity, avg(wind_speed) AS avg_wind_speed FROM gold "
    "WHERE observation_date + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(observation_time)) - INTERVAL 24 HOUR FROM gold) GROUP BY 1, 2",
    "avg_temperature avg_humidity avg_wind_speed",
)
def stream_daily_summary(spark, d):
    """Days that the watermark, a day behind the newest reading, has passed."""
    rows = score(observed(event_stream(spark, d))).filter("is_valid")
    path = scratch_path(spark, "stream-daily")
    pipelines.append_to(
        pipelines.daily_summary(rows), path, scratch_path(spark, "stream-state")
    ).awaitTermination()
    return spark.read.parquet(path)


@register(
    "stream_first_wins",
    f"WITH {OBS} SELECT city, observation_time, temperature_celsius FROM obs",
)
def stream_first_wins(spark, d):
    """Every reading arrives twice and is kept once."""
    twice = observed(event_stream(spark, d)).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    path = scratch_path(spark, "stream-first")
    pipelines.append_to(
        pipelines.first_wins(twice).select("city", "observation_time", "temperature_celsius"),
        path,
        scratch_path(spark, "stream-state"),
    ).awaitTermination()
    return spark.read.parquet(path)


def in_batches(spark, rows, batch, number: int, label: str):
    """Rows as a stream of several files, one a micro-batch: ``batch`` numbers them in the order of arrival."""
    path = scratch_path(spark, label)
    rows = written(rows.withColumn("_batch", batch), "rows")
    for i in range(number):
        rows.filter(F.col("_batch") == i).drop("_batch").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.drop("_batch").schema).option("maxFilesPerTrigger", 1).parquet(path)


EVENT = (
    "CASE WHEN temperature_celsius > 35 THEN 'Heatwave' WHEN wind_speed > 50 OR weather_main = 'Thunderstorm' THEN 'Storm' WHEN weather_main = 'Rain' THEN 'Heavy Rain' END"
)


@register(
    "stream_event_sessions",
    f"WITH {GOLD}, e AS (SELECT city, observation_time, {EVENT} AS event_type FROM gold), "
    "m AS (SELECT date_trunc('millisecond', max(observation_time)) - INTERVAL 24 HOUR AS mark FROM e), "
    "g AS (SELECT *, observation_time - lag(observation_time) OVER w >= INTERVAL 6 HOUR AS cut FROM e WHERE event_type IS NOT NULL WINDOW w AS (PARTITION BY city, event_type ORDER BY observation_time)), "
    "s AS (SELECT *, sum(CASE WHEN coalesce(cut, TRUE) THEN 1 ELSE 0 END) OVER (PARTITION BY city, event_type ORDER BY observation_time) AS episode FROM g) "
    "SELECT city, event_type, count(*) AS readings, min(observation_time) AS started, max(observation_time) AS ended, "
    "date_sub('minute', min(observation_time), max(observation_time)) AS event_duration_minutes FROM s GROUP BY city, event_type, episode "
    "HAVING max(observation_time) + INTERVAL 6 HOUR <= (SELECT mark FROM m)",
)
def stream_event_sessions(spark, d):
    """Episodes over five micro-batches; a third of the last twelve hours of each arrives with the next."""
    rows = score(observed(table(spark, d, "events"))).filter("is_valid")
    rows = rows.select("city", "observation_time", "temperature_celsius", "wind_speed", "weather_main")
    hours = F.floor((F.unix_micros(F.col("observation_time").cast("timestamp")) / 3_600_000_000)).cast("bigint")
    first = hours - F.lit(473_352)  # hours since 2024
    slice_ = F.floor(first / 144)
    late = (F.pmod(first, F.lit(144)) >= 132) & (F.pmod(F.xxhash64("city", "observation_time"), F.lit(3)) == 0)
    batch = F.least(F.greatest(slice_ + late.cast("int"), F.lit(0)), F.lit(5))
    stream = in_batches(spark, rows, batch, 6, "stream-events")
    path = scratch_path(spark, "stream-sessions")
    pipelines.append_to(pipelines.event_sessions(stream, "6 hours"), path, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(path)


@register(
    "stream_forecasts",
    f"WITH {GOLD}, daily AS ({DAILY_VIEW}) "
    "SELECT p.city, p.observation_date + 1 AS forecast_date, CAST(24 AS INTEGER) AS forecast_horizon_hours, p.avg_temperature AS predicted_temp, a.avg_temperature AS actual_temp, "
    "abs(p.avg_temperature - a.avg_temperature) AS absolute_error, abs(p.avg_temperature - a.avg_temperature) / nullif(abs(a.avg_temperature), 0) * 100 AS percentage_error, "
    "greatest(0.0, 100 - abs(p.avg_temperature - a.avg_temperature) / nullif(abs(a.avg_temperature), 0) * 100) AS accuracy_score, "
    "abs(p.avg_temperature - a.avg_temperature) / nullif(abs(a.avg_temperature), 0) * 100 <= 10 AS is_accurate "
    "FROM daily AS p JOIN daily AS a ON a.city = p.city AND a.observation_date = p.observation_date + 1",
    "predicted_temp actual_temp absolute_error percentage_error accuracy_score",
)
def stream_forecasts(spark, d):
    """Forecasts and days as two streams of four micro-batches, some days a batch late."""
    daily = written(gold.daily_view(score(observed(table(spark, d, "events"))).filter("is_valid")), "daily")
    number = F.datediff(F.col("observation_date"), F.lit("2024-01-01").cast("date"))
    late = (F.pmod(number, F.lit(10)) == 9) & (F.pmod(F.xxhash64("city"), F.lit(2)) == 0)
    batch = F.least(F.greatest(F.floor(number / 10) + late.cast("int"), F.lit(0)), F.lit(3))
    days = in_batches(spark, daily, batch, 4, "stream-days")
    forecasts = in_batches(spark, declared.persistence_forecast(daily).withColumn("observation_date", F.date_sub("forecast_date", 1)), batch, 4, "stream-forecasts")
    path = scratch_path(spark, "stream-met")
    met = pipelines.forecasts_met(forecasts.drop("observation_date"), days, "12 days")
    pipelines.append_to(met, path, scratch_path(spark, "stream-state")).awaitTermination()
    return spark.read.parquet(path)
