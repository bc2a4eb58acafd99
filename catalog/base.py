"""Registry of queries, and the binding of the given tables to observation roles.

``events`` plays the part of the observations: user is the key, ``ts`` the time,
``value`` the temperature, the number in ``props`` the humidity; pressure and
wind are arithmetic on the event id and the category is the event type by
another name. The raw layer holds every event twice: as first loaded and, an
hour later, as corrected by half a degree.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.plans.silver import score

AS_OF = "2024-01-31 00:00:00"
DIGITS = 6
# Averages of 2^k values often end in an exact half of the last digit, where errors
# of summation would decide: both sides round as decimals, which have no such errors.
EXACT = "DECIMAL(38, 10)"

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None, rounded: str = "", big: str = ""):
    """Register a plan with its SQL.

    Both sides round the columns ``rounded`` alike, since sums of doubles depend
    on their order, and hold the columns ``big`` as BIGINT.
    """
    digits, longs = rounded.split(), big.split()

    def wrap(plan: Plan) -> Plan:
        def bound(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = plan(spark, sf_dir)
            return df.withColumns(
                {c: F.round(F.col(c).cast(EXACT), DIGITS).cast("double") for c in digits} | {c: F.col(c).cast("bigint") for c in longs}
            )

        text = sql
        if sql and (digits or longs):
            parts = [f"CAST(round(CAST({c} AS {EXACT}), {DIGITS}) AS DOUBLE) AS {c}" for c in digits]
            parts += [f"CAST({c} AS BIGINT) AS {c}" for c in longs]
            text = f"SELECT * REPLACE ({', '.join(parts)}) FROM ({sql}) AS q"
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(bound if digits or longs else plan, text)
        return plan

    return wrap


def now():
    return F.lit(AS_OF).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return observed(e)


def observed(e: DataFrame) -> DataFrame:
    category = (
        F.when(F.col("event_type") == "error", "Thunderstorm")
        .when(F.col("event_type") == "purchase", "Rain")
        .when(F.col("event_type") == "click", "Clear")
        .when(F.col("event_type") == "view", "Clouds")
        .otherwise("Mist")
    )
    # a generator: the text is parsed once, however often the number is used
    return e.select("*", F.json_tuple("props", "k").alias("k")).select(
        F.concat(F.lit("station-"), F.col("user_id")).alias("city"),
        F.col("ts").alias("observation_time"),
        F.col("value").alias("temperature_celsius"),
        F.col("k").cast("int").alias("humidity"),
        (F.col("event_id") % 350 + 780).cast("int").alias("pressure"),
        (F.col("event_id") % 170).cast("double").alias("wind_speed"),
        category.alias("weather_main"),
        F.concat(F.lower(category), F.lit(" conditions")).alias("weather_description"),
        F.col("event_id").cast("string").alias("ingestion_id"),
        (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("ingestion_time"),
        (F.col("ts") + F.expr("INTERVAL 10 MINUTES")).alias("processed_time"),
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(observations(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level valid readings."""
    return silver(spark, sf_dir).filter("is_valid")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records: each event as loaded first, and as corrected an hour later."""
    return raw_of(observations(spark, sf_dir))


def raw_of(obs: DataFrame) -> DataFrame:
    from gaugeflow.sources.raw import build_raw

    copy = F.explode(F.array(F.lit(0), F.lit(1)))
    both = obs.withColumn("_copy", copy).withColumn(
        "temperature", F.col("temperature_celsius") + F.col("_copy") * 0.5
    )
    loaded = both.withColumns(
        {
            "ingestion_time": F.col("ingestion_time") + F.col("_copy") * F.expr("INTERVAL 1 HOUR"),
            "ingestion_id": F.concat_ws("-", "ingestion_id", F.col("_copy").cast("string")),
            "timestamp": F.date_format("observation_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "api_response_time": F.lit(0.5),
        }
    )
    return build_raw(
        loaded,
        "city",
        [
            "city",
            "temperature",
            "humidity",
            "pressure",
            "wind_speed",
            "weather_main",
            "weather_description",
            "timestamp",
            "api_response_time",
        ],
        ingestion_id=F.col("ingestion_id"),
        ingestion_time=F.col("ingestion_time"),
        response_time=F.col("api_response_time"),
    )


# ---------------------------------------------------------------- the same in SQL

OBS = """obs AS (
  SELECT 'station-' || user_id AS city, ts AS observation_time, value AS temperature_celsius,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS humidity,
         CAST(780 + event_id % 350 AS INTEGER) AS pressure,
         CAST(event_id % 170 AS DOUBLE) AS wind_speed,
         CASE event_type WHEN 'error' THEN 'Thunderstorm' WHEN 'purchase' THEN 'Rain'
              WHEN 'click' THEN 'Clear' WHEN 'view' THEN 'Clouds' ELSE 'Mist' END AS weather_main,
         CAST(event_id AS VARCHAR) AS ingestion_id,
         ts + INTERVAL 5 MINUTE AS ingestion_time, ts + INTERVAL 10 MINUTE AS processed_time
  FROM events)"""

_SCORED = """SELECT *, lower(weather_main) || ' conditions' AS weather_description,
         CAST((temperature_celsius BETWEEN -50 AND 60)::INT + (humidity BETWEEN 0 AND 100)::INT
            + (pressure BETWEEN 800 AND 1100)::INT + (wind_speed BETWEEN 0 AND 150)::INT + 1 AS INTEGER)
           AS quality_checks_passed,
         CAST(5 AS INTEGER) AS quality_checks_total"""

SILVER = f"""{OBS}, silver AS (
  SELECT *, quality_checks_passed = quality_checks_total AS is_valid FROM ({_SCORED} FROM obs) AS s)"""

GOLD = f"""{SILVER}, gold AS (SELECT *, CAST(observation_time AS DATE) AS observation_date FROM silver WHERE is_valid)"""

RAW = f"""{OBS}, raw AS (
  SELECT ingestion_id || '-' || c.copy AS ingestion_id,
         ingestion_time + c.copy * INTERVAL 1 HOUR AS ingestion_time, 'openweathermap' AS source,
         city AS source_city, temperature_celsius + c.copy * 0.5 AS temperature, humidity, pressure, wind_speed,
         weather_main, lower(weather_main) || ' conditions' AS weather_description, observation_time
  FROM obs CROSS JOIN (VALUES (0), (1)) AS c(copy))"""


def with_gold(body: str, more: str = "") -> str:
    return f"WITH {GOLD}{', ' + more if more else ''} {body}"


def with_silver(body: str, more: str = "") -> str:
    return f"WITH {SILVER}{', ' + more if more else ''} {body}"


def with_raw(body: str, more: str = "") -> str:
    return f"WITH {RAW}{', ' + more if more else ''} {body}"


def mode_sql(source: str, keys: str, category: str, name: str, where: str = "TRUE") -> str:
    """Most common category per key, the smallest of equal ones."""
    return (
        f"SELECT {keys}, {category} AS {name} FROM (SELECT {keys}, {category}, row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY count(*) DESC, {category}) AS p FROM {source} WHERE {where} "
        f"GROUP BY {keys}, {category}) AS m WHERE p = 1"
    )


NOW = f"TIMESTAMP '{AS_OF}'"
TODAY = "DATE '2024-01-31'"
