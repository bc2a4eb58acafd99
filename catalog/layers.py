"""Raw and silver layer, daily summaries, events."""

from pyspark.sql import functions as F

from catalog.base import (
    AS_OF,
    GOLD,
    NOW,
    RAW,
    TODAY,
    gold,
    mode_sql,
    now,
    observations,
    raw,
    register,
    silver,
    table,
    with_gold,
    with_raw,
    with_silver,
)
from gaugeflow.functions import rules
from gaugeflow.operators.grouping import latest_per
from gaugeflow.plans import gold as plans
from gaugeflow.plans import silver as silver_plans
from gaugeflow.sources import raw as raw_source
from gaugeflow.spec import since_days, split_at

RAW_ROWS = "ingestion_id, ingestion_time, source_city, temperature, humidity, pressure, wind_speed, weather_main, weather_description, observation_time"

CLEAN = f"""clean AS (
  SELECT source_city AS city, temperature AS temperature_celsius, humidity, pressure, wind_speed, weather_main,
         weather_description, observation_time, ingestion_id, {NOW} AS processed_time,
         quality_checks_passed = 5 AS is_valid, quality_checks_passed, CAST(5 AS INTEGER) AS quality_checks_total
  FROM (SELECT *, CAST((temperature BETWEEN -50 AND 60)::INT + (humidity BETWEEN 0 AND 100)::INT
            + (pressure BETWEEN 800 AND 1100)::INT + (wind_speed BETWEEN 0 AND 150)::INT + 1 AS INTEGER)
            AS quality_checks_passed,
          row_number() OVER (PARTITION BY source_city, observation_time ORDER BY ingestion_time DESC, ingestion_id DESC) AS p
        FROM raw) AS r
  WHERE p = 1)"""


def clean(spark, d):
    return silver_plans.clean(raw_source.scan(raw(spark, d)), now(), "timestamp_ntz")


def class_sql(t: str) -> str:
    return (
        f"CASE WHEN {t} < 0 THEN 'Freezing' WHEN {t} < 10 THEN 'Cold' WHEN {t} < 20 THEN 'Mild' "
        f"WHEN {t} < 30 THEN 'Warm' ELSE 'Hot' END"
    )


def daily_sql(source: str) -> str:
    day = "city, observation_date"
    return f"""SELECT s.*, m.most_common_weather, {class_sql('s.avg_temperature')} AS temp_category, {NOW} AS last_updated
FROM (SELECT city, CAST(observation_time AS DATE) AS observation_date, count(*) AS record_count,
             avg(temperature_celsius) AS avg_temperature, avg(humidity) AS avg_humidity,
             avg(wind_speed) AS avg_wind_speed, max(temperature_celsius) AS max_temperature,
             min(temperature_celsius) AS min_temperature
      FROM {source} WHERE is_valid GROUP BY 1, 2) AS s
JOIN ({mode_sql(f'(SELECT *, CAST(observation_time AS DATE) AS observation_date FROM {source} WHERE is_valid) AS v', day, 'weather_main', 'most_common_weather')}) AS m
  USING (city, observation_date)"""


DAILY_DOUBLES = "avg_temperature avg_humidity avg_wind_speed max_temperature min_temperature"


@register("medallion_daily_summary", f"WITH {RAW}, {CLEAN} {daily_sql('clean')}", DAILY_DOUBLES)
def medallion_daily_summary(spark, d):
    return plans.daily_summary(silver_plans.valid(clean(spark, d)), now())


@register("raw_scan", with_raw("SELECT ingestion_id, ingestion_time, source_city FROM raw"))
def raw_scan(spark, d):
    return raw_source.scan(raw(spark, d)).select("ingestion_id", "ingestion_time", "source_city")


@register(
    "raw_increment",
    with_raw(
        "SELECT ingestion_id, ingestion_time, source_city FROM raw "
        "WHERE ingestion_time >= (SELECT max(ingestion_time) - INTERVAL 24 HOUR FROM raw)"
    ),
)
def raw_increment(spark, d):
    return raw_source.scan_increment(raw(spark, d)).select("ingestion_id", "ingestion_time", "source_city")


@register("raw_flatten", with_raw(f"SELECT {RAW_ROWS} FROM raw"))
def raw_flatten(spark, d):
    return raw_source.flatten(raw(spark, d), "timestamp_ntz")


@register(
    "raw_from_api",
    with_gold(
        "SELECT city, temperature_celsius AS temperature, humidity, pressure, wind_speed, weather_main, "
        "weather_description, date_trunc('second', observation_time) AS observed_at FROM silver"
    ),
)
def raw_from_api(spark, d):
    doc = F.to_json(
        F.struct(
            F.struct(F.col("temperature_celsius").alias("temp"), "humidity", "pressure").alias("main"),
            F.struct(F.col("wind_speed").alias("speed")).alias("wind"),
            F.array(
                F.struct(F.col("weather_main").alias("main"), F.col("weather_description").alias("description"))
            ).alias("weather"),
            F.floor(F.unix_micros(F.col("observation_time").cast("timestamp")) / 1_000_000).alias("dt"),
        )
    )
    landed = observations(spark, d).select("city", doc.alias("body"))
    return (
        raw_source.from_api(landed, "body", "city")
        .withColumn("observed_at", F.col("timestamp").cast("timestamp_ntz"))
        .drop("timestamp")
    )


@register(
    "raw_snapshot_as_of",
    with_raw(
        "SELECT source_city, observation_time, ingestion_id, ingestion_time, temperature FROM "
        "(SELECT *, row_number() OVER (PARTITION BY source_city, observation_time ORDER BY ingestion_time DESC, ingestion_id DESC) AS p "
        "FROM raw WHERE ingestion_time <= TIMESTAMP '2024-01-15 00:00:00') AS r WHERE p = 1"
    ),
)
def raw_snapshot_as_of(spark, d):
    log = raw_source.flatten(raw(spark, d), "timestamp_ntz").select(
        "source_city", "observation_time", "ingestion_id", "ingestion_time", "temperature"
    )
    return raw_source.snapshot(
        log, ["source_city", "observation_time"], "2024-01-15 00:00:00", "ingestion_time", "ingestion_id"
    )


@register(
    "raw_retention",
    with_raw(f"SELECT ingestion_id, ingestion_time FROM raw WHERE ingestion_time >= {NOW} - INTERVAL 10 DAY"),
)
def raw_retention(spark, d):
    return raw_source.retained(raw(spark, d), 10, AS_OF).select("ingestion_id", "ingestion_time")


@register("silver_clean", f"WITH {RAW}, {CLEAN} SELECT * FROM clean")
def silver_clean(spark, d):
    return clean(spark, d)


@register(
    "silver_deduplicate",
    "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM "
    "(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, "
    "l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS p FROM lineitem) AS x WHERE p = 1",
)
def silver_deduplicate(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return latest_per(
        rows,
        ["l_orderkey", "l_linenumber"],
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
    )


@register(
    "silver_score",
    with_silver(
        "SELECT city, observation_time, quality_checks_passed, quality_checks_total, is_valid FROM silver"
    ),
)
def silver_score(spark, d):
    return silver(spark, d).select(
        "city", "observation_time", "quality_checks_passed", "quality_checks_total", "is_valid"
    )


@register(
    "silver_validate",
    with_silver(
        "SELECT city, observation_time, CASE WHEN temperature_celsius BETWEEN -50 AND 60 AND humidity BETWEEN 0 AND 100 "
        "THEN 'accepted' ELSE 'rejected' END AS outcome FROM obs"
    ),
)
def silver_validate(spark, d):
    accepted, rejected = silver_plans.validate(observations(spark, d).select("city", "observation_time", "temperature_celsius", "humidity"))
    return accepted.withColumn("outcome", F.lit("accepted")).unionByName(
        rejected.withColumn("outcome", F.lit("rejected"))
    ).select("city", "observation_time", "outcome")


@register(
    "silver_utc",
    with_silver(
        "SELECT city, observation_time, observation_time - INTERVAL 9 HOUR AS observation_time_utc FROM obs"
    ),
)
def silver_utc(spark, d):
    rows = observations(spark, d).select("city", "observation_time")
    utc = silver_plans.standardise_times(rows, "Asia/Tokyo")
    return utc.withColumn("observation_time_utc", F.col("observation_time_utc").cast("timestamp_ntz"))


@register(
    "silver_passing_insert",
    with_silver(
        f"SELECT city, observation_time, {NOW} AS processed_time, TRUE AS is_valid, CAST(5 AS INTEGER) AS quality_checks_passed, "
        "CAST(5 AS INTEGER) AS quality_checks_total FROM obs "
        "WHERE temperature_celsius BETWEEN -50 AND 60 AND humidity BETWEEN 0 AND 100"
    ),
)
def silver_passing_insert(spark, d):
    accepted, _ = silver_plans.validate(observations(spark, d))
    return silver_plans.passing(accepted, now()).select(
        "city", "observation_time", "processed_time", "is_valid", "quality_checks_passed", "quality_checks_total"
    )


@register(
    "silver_recent_valid",
    with_silver(
        f"SELECT city, observation_time, temperature_celsius FROM silver WHERE is_valid AND observation_time >= {TODAY} - INTERVAL 20 DAY"
    ),
)
def silver_recent_valid(spark, d):
    return silver_plans.valid(silver(spark, d), 20, AS_OF).select("city", "observation_time", "temperature_celsius")


@register(
    "staging",
    with_silver(
        "SELECT city, temperature_celsius, humidity, pressure, wind_speed, weather_main, weather_description, "
        f"observation_time, 'sample' AS ingestion_id, {NOW} AS processed_time FROM silver WHERE is_valid"
    ),
)
def staging(spark, d):
    return silver_plans.staging(silver(spark, d), processed=now())


LOOKBACKS = {"6h": (6, 0), "24h": (24, 0), "7d": (0, 7), "30d": (0, 30), "90d": (0, 90)}


@register(
    "lookback_counts",
    with_gold(
        " UNION ALL ".join(
            f"SELECT '{label}' AS period, count(*) AS readings FROM gold WHERE observation_time >= "
            + (f"{NOW} - INTERVAL {h} HOUR" if h else f"{TODAY} - INTERVAL {n} DAY")
            for label, (h, n) in LOOKBACKS.items()
        )
    ),
)
def lookback_counts(spark, d):
    """All look-backs in one pass over the rows."""
    from gaugeflow.spec import anchor

    rows = gold(spark, d)
    now = anchor(AS_OF, rows, "observation_time")
    starts = {
        label: now - F.expr(f"INTERVAL {h} HOURS")
        if h
        else F.date_sub(F.to_date(now), n).cast("timestamp_ntz")
        for label, (h, n) in LOOKBACKS.items()
    }
    line = rows.agg(*[F.count_if(F.col("observation_time") >= s).alias(label) for label, s in starts.items()])
    return line.unpivot([], list(starts), "period", "readings")


@register(
    "filter_keys",
    with_gold("SELECT city, count(*) AS readings FROM gold WHERE city IN ('station-1', 'station-2', 'station-3') GROUP BY city"),
)
def filter_keys(spark, d):
    rows = gold(spark, d).filter(F.col("city").isin("station-1", "station-2", "station-3"))
    return rows.groupBy("city").agg(F.count(F.lit(1)).alias("readings"))


@register(
    "past_and_future",
    with_gold(
        "SELECT CASE WHEN observation_time <= TIMESTAMP '2024-01-20 00:00:00' THEN 'past' ELSE 'future' END AS part, "
        "city, observation_time, temperature_celsius FROM gold"
    ),
)
def past_and_future(spark, d):
    rows = gold(spark, d).select("city", "observation_time", "temperature_celsius")
    past, future = split_at(rows, "2024-01-20 00:00:00")
    return past.withColumn("part", F.lit("past")).unionByName(future.withColumn("part", F.lit("future")))


@register("daily_summary", f"WITH {GOLD} {daily_sql('silver')}", DAILY_DOUBLES)
def daily_summary(spark, d):
    return plans.daily_summary(gold(spark, d), now())


@register(
    "daily_conditions",
    with_gold(
        "SELECT city, observation_date, weather_main, count(*) AS occurrence_count FROM gold GROUP BY 1, 2, 3"
    ),
)
def daily_conditions(spark, d):
    return plans.daily_conditions(gold(spark, d))


@register(
    "daily_weather_types",
    with_gold(
        "SELECT city, observation_date, CAST(to_json(list(struct_pack(weather := weather_main, count := n) ORDER BY weather_main)) AS VARCHAR) AS weather_types "
        "FROM (SELECT city, observation_date, weather_main, count(*) AS n FROM gold GROUP BY 1, 2, 3) AS c GROUP BY 1, 2"
    ),
)
def daily_weather_types(spark, d):
    return plans.daily_weather_types(gold(spark, d))


DAILY_VIEW = (
    "SELECT city, observation_date, avg(temperature_celsius) AS avg_temperature, max(temperature_celsius) AS max_temperature, "
    "min(temperature_celsius) AS min_temperature, avg(humidity) AS avg_humidity, avg(wind_speed) AS avg_wind_speed, "
    "count(*) AS record_count FROM gold GROUP BY city, observation_date"
)


@register("daily_view", with_gold(DAILY_VIEW), DAILY_DOUBLES)
def daily_view(spark, d):
    return plans.daily_view(gold(spark, d))


@register("key_summary", with_gold(f"SELECT * FROM ({DAILY_VIEW}) AS v WHERE city = 'station-7'"), DAILY_DOUBLES)
def key_summary(spark, d):
    return plans.key_summary(gold(spark, d), "station-7")


EVENT = (
    "CASE WHEN temperature_celsius > 35 THEN 'Heatwave' WHEN wind_speed > 50 OR weather_main = 'Thunderstorm' THEN 'Storm' "
    "WHEN weather_main = 'Rain' THEN 'Heavy Rain' END"
)


@register(
    "events_detected",
    with_gold(
        f"SELECT city, observation_time, temperature_celsius, wind_speed, weather_main, weather_description, {EVENT} AS event_type, "
        f"{NOW} AS detection_time FROM gold WHERE {EVENT} IS NOT NULL"
    ),
)
def events_detected(spark, d):
    return plans.detected_events(gold(spark, d), now())


@register(
    "event_counts",
    with_gold(
        f"SELECT city, {EVENT} AS event_type, count(*) AS event_count, min(observation_time) AS first_event, "
        f"max(observation_time) AS last_event FROM gold WHERE {EVENT} IS NOT NULL GROUP BY 1, 2"
    ),
)
def event_counts(spark, d):
    return plans.event_counts(plans.detected_events(gold(spark, d)))


@register(
    "events_listed",
    with_gold(
        "SELECT city, observation_time, temperature_celsius, wind_speed, weather_main, weather_description, "
        "CASE WHEN temperature_celsius > 35 THEN 'Heatwave' WHEN wind_speed > 50 THEN 'Storm' WHEN weather_main = 'Rain' "
        f"THEN 'Heavy Rain' ELSE 'Other' END AS event_type FROM gold WHERE observation_time >= {TODAY} - INTERVAL 7 DAY "
        "AND (temperature_celsius > 35 OR wind_speed > 50 OR weather_main = 'Rain')"
    ),
)
def events_listed(spark, d):
    return plans.listed_events(gold(spark, d), 7, AS_OF)


ALERT = (
    "CASE WHEN temperature_celsius > 35 THEN 'Heatwave Alert' WHEN wind_speed > 50 THEN 'Storm Alert' "
    "WHEN weather_main = 'Rain' THEN 'Rain Alert' ELSE 'Normal' END"
)


@register(
    "alert_levels",
    with_gold(f"SELECT city, observation_time, {ALERT} AS alert_level FROM gold"),
)
def alert_levels(spark, d):
    return gold(spark, d).select("city", "observation_time", rules.alert_level().alias("alert_level"))


@register(
    "key_alerts",
    with_gold(
        f"SELECT observation_time, temperature_celsius, wind_speed, weather_main, {ALERT} AS alert_level FROM gold "
        f"WHERE city = 'station-5' AND {ALERT} <> 'Normal' AND observation_time >= {TODAY} - INTERVAL 30 DAY "
        "ORDER BY observation_time DESC LIMIT 10"
    ),
)
def key_alerts(spark, d):
    return plans.key_alerts(gold(spark, d), "station-5", 10, 30, AS_OF)


@register(
    "temperature_classes",
    with_gold(f"SELECT city, observation_time, {class_sql('temperature_celsius')} AS temperature_category FROM gold"),
)
def temperature_classes(spark, d):
    return gold(spark, d).select(
        "city",
        "observation_time",
        rules.temperature_class(F.col("temperature_celsius")).alias("temperature_category"),
    )


@register(
    "lookback_key_values",
    with_gold(f"SELECT DISTINCT city FROM gold WHERE observation_time >= {TODAY} - INTERVAL 2 DAY"),
)
def lookback_key_values(spark, d):
    return since_days(gold(spark, d), 2, AS_OF).select("city").distinct()


@register("raw_default_ids", "SELECT count(*) AS records, count(*) AS identifiers FROM events")
def raw_default_ids(spark, d):
    """Records without an identifier of their own get a random one each."""
    from gaugeflow.sources.raw import build_raw

    made = build_raw(observations(spark, d), "city", ["city", "humidity"])
    return made.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("ingestion_id").alias("identifiers"))


@register("deduplicate_any_order", "SELECT * EXCLUDE (p) FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey DESC) AS p FROM orders) AS q WHERE p = 1")
def deduplicate_any_order(spark, d):
    """The cheapest order of each customer, the last of equal ones."""
    from gaugeflow.operators.grouping import deduplicate

    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return deduplicate(rows, ["o_custkey"], F.col("o_totalprice"), F.col("o_orderkey").desc())
