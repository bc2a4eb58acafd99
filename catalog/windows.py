"""Rolling averages, changes, ranks, quantiles, latest rows."""

from pyspark.sql import functions as F

from catalog.base import AS_OF, NOW, TODAY, gold, now, register, table, with_gold
from gaugeflow.operators.grouping import latest_per
from gaugeflow.operators.ordered import group_size, neighbour, quantiles, ranks, rolling_range, row_numbers
from gaugeflow.plans import gold as plans
from gaugeflow.plans import reports, sketches
from gaugeflow.runtime import scratch_path
from gaugeflow.sources import staging
from gaugeflow.spec import since_days

LAG = "lag(temperature_celsius) OVER (PARTITION BY city ORDER BY observation_time)"
TREND_CLASS = "CASE WHEN {c} > 2 THEN 'Rising' WHEN {c} < -2 THEN 'Falling' ELSE 'Stable' END"

TRENDS = f"""trends AS (
  SELECT city, observation_time, temperature_celsius,
    avg(temperature_celsius) OVER (PARTITION BY city ORDER BY observation_time RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS rolling_24h_avg_temp,
    avg(temperature_celsius) OVER (PARTITION BY city ORDER BY observation_time RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS rolling_7d_avg_temp,
    temperature_celsius - prev AS temp_change_24h,
    CASE WHEN prev <> 0 THEN (temperature_celsius - prev) / prev * 100 ELSE 0 END AS temp_change_pct,
    {TREND_CLASS.format(c='temperature_celsius - prev')} AS trend_direction
  FROM (SELECT *, {LAG} AS prev FROM gold) AS g)"""
TREND_DOUBLES = "rolling_24h_avg_temp rolling_7d_avg_temp temp_change_24h temp_change_pct"


@register("trends", with_gold(f"SELECT *, {NOW} AS last_updated FROM trends", TRENDS), TREND_DOUBLES)
def trends(spark, d):
    return plans.trends(gold(spark, d), now())


@register(
    "recent_trends",
    with_gold(
        "SELECT city, observation_time, temperature_celsius, rolling_24h_avg_temp, rolling_7d_avg_temp, trend_direction "
        f"FROM trends WHERE observation_time >= {TODAY} - INTERVAL 7 DAY",
        TRENDS,
    ),
    "rolling_24h_avg_temp rolling_7d_avg_temp",
)
def recent_trends(spark, d):
    return plans.recent_trends(plans.trends(gold(spark, d)), 7, AS_OF)


@register(
    "rolling_rows",
    with_gold(
        "SELECT city, observation_time, temperature_celsius, "
        "avg(temperature_celsius) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS rolling_24h_avg, "
        "avg(temperature_celsius) OVER (w ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS rolling_7d_avg, "
        f"temperature_celsius - {LAG} AS temp_change FROM gold WINDOW w AS (PARTITION BY city ORDER BY observation_time)"
    ),
    "rolling_24h_avg rolling_7d_avg temp_change",
)
def rolling_rows(spark, d):
    return plans.trend_view(gold(spark, d))


@register(
    "moving_average_full",
    with_gold(
        "SELECT city, observation_time, temperature_celsius, "
        "CASE WHEN count(*) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) = 24 "
        "THEN avg(temperature_celsius) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) END AS ma_24h, "
        "CASE WHEN count(*) OVER (w ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) = 168 "
        "THEN avg(temperature_celsius) OVER (w ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) END AS ma_7d "
        "FROM gold WINDOW w AS (PARTITION BY city ORDER BY observation_time)"
    ),
    "ma_24h ma_7d",
)
def moving_average_full(spark, d):
    return plans.full_moving_averages(gold(spark, d))


@register(
    "changes",
    with_gold(
        f"SELECT city, observation_time, temperature_celsius, {LAG} AS prev_temp, temperature_celsius - {LAG} AS temp_change, "
        f"CASE WHEN {LAG} <> 0 THEN (temperature_celsius - {LAG}) / {LAG} * 100 ELSE 0 END AS temp_change_pct FROM gold"
    ),
    "temp_change temp_change_pct",
)
def changes(spark, d):
    moved = plans.changes(gold(spark, d).select("city", "observation_time", "temperature_celsius"))
    return moved.withColumn(
        "temp_change_pct", plans.change_percent(F.col("temperature_celsius"), F.col("prev_temp"))
    )


@register(
    "change_24h",
    with_gold(
        "SELECT city, observation_time, temperature_celsius, temp_24h_ago, temperature_celsius - temp_24h_ago AS temp_change_24h FROM "
        "(SELECT *, first_value(temperature_celsius) OVER (PARTITION BY city ORDER BY observation_time RANGE BETWEEN INTERVAL 24 HOUR "
        "PRECEDING AND CURRENT ROW) AS temp_24h_ago FROM gold) AS g"
    ),
    "temp_change_24h",
)
def change_24h(spark, d):
    return plans.change_24h(gold(spark, d))


@register(
    "key_series",
    with_gold(
        "SELECT city, observation_time, temperature_celsius, humidity, wind_speed, weather_main, weather_description, "
        f"{LAG} AS prev_temp, temperature_celsius - {LAG} AS temp_change FROM gold WHERE observation_time >= {TODAY} - INTERVAL 7 DAY"
    ),
    "temp_change",
)
def key_series(spark, d):
    return plans.series(gold(spark, d), 7, AS_OF)


@register(
    "daily_trend",
    with_gold(
        "SELECT *, avg(avg_temp) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_avg, "
        "avg(avg_temp) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_30d_avg FROM "
        "(SELECT city, observation_date, avg(temperature_celsius) AS avg_temp, min(temperature_celsius) AS min_temp, "
        "max(temperature_celsius) AS max_temp, count(*) AS reading_count FROM gold "
        f"WHERE observation_time >= {TODAY} - INTERVAL 30 DAY GROUP BY 1, 2) AS d WINDOW w AS (PARTITION BY city ORDER BY observation_date)"
    ),
    "avg_temp rolling_7d_avg rolling_30d_avg",
)
def daily_trend(spark, d):
    return reports.daily_trend(gold(spark, d), 30, AS_OF)


@register(
    "rank_readings",
    with_gold(
        "SELECT city, observation_time, temperature_celsius, rank() OVER (ORDER BY temperature_celsius DESC) AS rank_global, "
        "rank() OVER (PARTITION BY observation_date ORDER BY temperature_celsius DESC) AS rank_daily, "
        "percent_rank() OVER (ORDER BY temperature_celsius) AS percentile FROM gold"
    ),
    "percentile",
    "rank_global rank_daily",
)
def rank_readings(spark, d):
    rows = plans.with_date(gold(spark, d)).select("city", "observation_time", "observation_date", "temperature_celsius")
    t = "temperature_celsius"
    size = group_size(rows, ["observation_date"])
    ranked = ranks(rows, [], t, rank="rank_global", descending=True, size=size.whole())
    ranked = ranks(ranked, ["observation_date"], t, rank="rank_daily", descending=True, size=size)
    return ranks(ranked, [], t, percent_rank="percentile", size=size.whole()).drop("observation_date")


@register(
    "rank_orders",
    "SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice DESC) AS price_rank, "
    "rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS priority_rank FROM orders",
    big="price_rank priority_rank",
)
def rank_orders(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    size = group_size(rows, ["o_orderpriority"])
    ranked = ranks(rows, [], "o_totalprice", rank="price_rank", descending=True, size=size.whole())
    ranked = ranks(ranked, ["o_orderpriority"], "o_totalprice", rank="priority_rank", descending=True, size=size)
    return ranked.select("o_orderkey", "price_rank", "priority_rank")


@register(
    "row_numbers",
    "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS position FROM events",
    big="position",
)
def numbered(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type", "ts")
    return row_numbers(rows, ["event_type"], ["ts", "event_id"], "position").select("event_id", "position")


@register(
    "next_order",
    "SELECT o_orderkey, o_custkey, o_orderdate, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_date "
    "FROM orders",
)
def next_order(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return neighbour(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"next_date": "o_orderdate"}, ahead=True)


@register(
    "quartiles",
    with_gold(
        "SELECT city, quantile_cont(temperature_celsius, 0.0) AS low, quantile_cont(temperature_celsius, 0.25) AS q1, quantile_cont(temperature_celsius, 0.5) AS median, "
        "quantile_cont(temperature_celsius, 0.75) AS q3, quantile_cont(temperature_celsius, 1.0) AS high FROM gold GROUP BY city"
    ),
    "low q1 median q3 high",
)
def quartiles(spark, d):
    return quantiles(
        gold(spark, d),
        ["city"],
        "temperature_celsius",
        {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0},
    )


@register(
    "current_conditions",
    with_gold(
        "SELECT city, observation_time, temperature_celsius, humidity, wind_speed, weather_main FROM "
        "(SELECT *, row_number() OVER (PARTITION BY city ORDER BY observation_time DESC) AS p FROM gold) AS g WHERE p = 1"
    ),
)
def current_conditions(spark, d):
    rows = gold(spark, d).select(
        "city", "observation_time", "temperature_celsius", "humidity", "wind_speed", "weather_main"
    )
    return plans.current_conditions(rows)


@register(
    "recent_readings",
    with_gold(
        "SELECT city, strftime(observation_time, '%Y-%m-%d %H:%M') AS observation_time, round(temperature_celsius, 1) AS temperature_celsius, "
        f"weather_main, humidity FROM gold WHERE observation_time >= {NOW} - INTERVAL 6 HOUR ORDER BY gold.observation_time DESC, ingestion_id LIMIT 20"
    ),
)
def recent_readings(spark, d):
    newest = plans.recent_readings(gold(spark, d), 20, 6, AS_OF, ("ingestion_id",))
    return newest.select(
        "city",
        F.date_format("observation_time", "yyyy-MM-dd HH:mm").alias("observation_time"),
        F.round("temperature_celsius", 1).alias("temperature_celsius"),
        "weather_main",
        "humidity",
    )


@register(
    "latest_order",
    "SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_orderdate DESC, o_orderkey DESC) AS p FROM orders) AS o WHERE p = 1",
)
def latest_order(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return latest_per(rows, ["o_custkey"], "o_orderdate", "o_orderkey")


ODD = (
    "odd AS (SELECT event_id, CASE WHEN user_id % 7 <> 0 THEN user_id END AS k, CASE WHEN event_id % 11 <> 0 THEN ts END AS t, "
    "CAST(value AS DECIMAL(12, 2)) AS v FROM events)"
)


def odd(spark, d):
    """Events of which some have no key and some no time."""
    return table(spark, d, "events").select(
        "event_id",
        F.when(F.col("user_id") % 7 != 0, F.col("user_id")).alias("k"),
        F.when(F.col("event_id") % 11 != 0, F.col("ts")).alias("t"),
        F.col("value").cast("decimal(12,2)").alias("v"),
    )


@register(
    "ranks_null_keys",
    f"WITH {ODD} SELECT event_id, rank() OVER w AS r, percent_rank() OVER w AS p FROM odd WINDOW w AS (PARTITION BY k ORDER BY v)",
    "p",
)
def ranks_null_keys(spark, d):
    return ranks(odd(spark, d), ["k"], "v", rank="r", percent_rank="p").select("event_id", "r", "p")


@register(
    "quantiles_null_keys",
    f"WITH {ODD} SELECT k, quantile_cont(CAST(v AS DOUBLE), 0.25) AS q, quantile_cont(CAST(v AS DOUBLE), 0.5) AS m FROM odd GROUP BY k",
    "q m",
)
def quantiles_null_keys(spark, d):
    return quantiles(odd(spark, d), ["k"], "v", {"q": 0.25, "m": 0.5})


@register(
    "rolling_null_times",
    f"WITH {ODD} SELECT event_id, count(v) OVER w AS n, CAST(sum(v) OVER w AS DOUBLE) AS s, max(CAST(v AS DOUBLE)) OVER w AS m FROM odd "
    "WINDOW w AS (PARTITION BY k ORDER BY t NULLS FIRST RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)",
    "s m",
)
def rolling_null_times(spark, d):
    frames = {"n": ("count", "v", 86_400), "s": ("sum", "v", 86_400), "m": ("max", "v", 86_400)}
    return rolling_range(odd(spark, d), ["k"], "t", frames).select("event_id", "n", "s", "m")


LOOKBACKS = (7, 30, 90)


@register(
    "sketched_lookbacks",
    with_gold(
        " UNION ALL ".join(
            f"SELECT city, {n} AS days, CAST(count(*) AS BIGINT) AS readings, count(humidity) > 0 AS median_fits, TRUE AS upper_fits, TRUE AS distinct_fits FROM gold "
            f"WHERE observation_date >= {TODAY} - {n} GROUP BY city"
            for n in LOOKBACKS
        )
    ),
)
def sketched_lookbacks(spark, d):
    """Quantiles and distinct counts over three look-backs from one stored table, held against the readings: within the stated errors."""
    path = scratch_path(spark, "sketches")
    rows = gold(spark, d)
    sketches.store(rows, path, ["temperature_celsius"], ["observation_time"])
    kept, out = staging.read(spark, path), None
    for days in LOOKBACKS:
        t = "temperature_celsius"
        got = sketches.look_back(kept, days, AS_OF, ["city"], {"median": (t, 0.5), "upper": (t, 0.9)}, {"times": "observation_time"})
        there = since_days(rows, days, AS_OF).withColumnRenamed("city", "_city").join(got, F.col("_city") == F.col("city"))
        below = {c: (F.avg((F.col(t) < F.col(c)).cast("int")), F.avg((F.col(t) <= F.col(c)).cast("int"))) for c in ("median", "upper")}
        fits = lambda c, p: (below[c][0] <= p + 2 * sketches.RANK_ERROR) & (below[c][1] >= p - 2 * sketches.RANK_ERROR)  # noqa: E731, B023
        exact = F.count_distinct("observation_time")
        line = there.groupBy("city").agg(
            F.max("readings").alias("readings"), fits("median", 0.5).alias("median_fits"), fits("upper", 0.9).alias("upper_fits"),
            (F.abs(F.max("times") - exact) <= 1 + 4 * sketches.DISTINCT_ERROR * exact).alias("distinct_fits"),
        )
        line = line.withColumn("days", F.lit(days))
        out = line if out is None else out.unionByName(line)
    return out
