"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from catalog.base import NOW, gold, now, register, table, with_gold
from gaugeflow.functions import scalars as fn
from gaugeflow.functions import times


@register(
    "safe_add_subtract",
    "SELECT c_custkey, coalesce(c_acctbal, 0) + coalesce(total, 0) AS added, coalesce(c_acctbal, 0) - coalesce(total, 0) AS subtracted FROM customer "
    "LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1) AS o ON o_custkey = c_custkey",
    "added subtracted",
)
def safe_add_subtract(spark, d):
    totals = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("total"))
    joined = table(spark, d, "customer").select("c_custkey", "c_acctbal").join(totals, "c_custkey", "left")
    return joined.select(
        "c_custkey",
        fn.safe_add("c_acctbal", "total").alias("added"),
        fn.safe_subtract("c_acctbal", "total").alias("subtracted"),
    )


@register(
    "safe_divide",
    "SELECT l_orderkey, l_linenumber, l_extendedprice, l_tax / nullif(l_discount, 0) AS ratio FROM lineitem",
    "ratio",
)
def safe_divide(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", fn.safe_divide("l_tax", "l_discount").alias("ratio")
    )


@register(
    "width_bucket",
    "SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 450000 THEN 9 ELSE floor((o_totalprice - 50000) / 50000) + 1 END AS BIGINT) AS bucket FROM orders",
)
def width_bucket(spark, d):
    return table(spark, d, "orders").select("o_orderkey", fn.bucket("o_totalprice", 50000, 450000, 8).alias("bucket"))


def haversine_sql(factor: str) -> str:
    return (
        "2 * 3961 * asin(sqrt(pow(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians((lon2 - lon1) / 2)), 2)))"
        + factor
    )


@register(
    "haversine",
    f"SELECT c_custkey, {haversine_sql('')} AS miles, {haversine_sql(' * 1.60934')} AS kilometres, radians(lat1) AS radians_1 FROM "
    "(SELECT c_custkey, CAST(c_custkey % 170 - 85 AS DOUBLE) AS lat1, CAST(c_custkey % 359 - 179 AS DOUBLE) AS lon1, "
    "c_acctbal / 200 AS lat2, CAST(c_nationkey * 7 AS DOUBLE) AS lon2 FROM customer) AS p",
    "miles kilometres radians_1",
)
def haversine(spark, d):
    points = table(spark, d, "customer").select(
        "c_custkey",
        (F.col("c_custkey") % 170 - 85).cast("double").alias("lat1"),
        (F.col("c_custkey") % 359 - 179).cast("double").alias("lon1"),
        (F.col("c_acctbal") / 200).alias("lat2"),
        (F.col("c_nationkey") * 7).cast("double").alias("lon2"),
    )
    at = [F.col(c) for c in ("lat1", "lon1", "lat2", "lon2")]
    return points.select(
        "c_custkey",
        fn.haversine(*at).alias("miles"),
        fn.haversine(*at, unit="km").alias("kilometres"),
        F.radians("lat1").alias("radians_1"),
    )


KEY_NULL = "_dbt_utils_surrogate_key_null_"


@register(
    "surrogate_key",
    f"SELECT doc_id, md5(concat_ws('-', CAST(doc_id AS VARCHAR), coalesce(CAST(quality AS VARCHAR), '{KEY_NULL}'), lang)) AS k, "
    "md5(concat_ws('-', CAST(doc_id AS VARCHAR), coalesce(CAST(quality AS VARCHAR), ''), lang)) AS k_empty FROM documents LEFT JOIN labels USING (doc_id)",
)
def surrogate_key(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    rows = docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return rows.select(
        "doc_id",
        fn.surrogate_key("doc_id", "quality", "lang").alias("k"),
        fn.surrogate_key("doc_id", "quality", "lang", null_as_empty=True).alias("k_empty"),
    )


BARE = "replace(replace(url, 'http://', ''), 'https://', '')"


@register(
    "url_parts",
    "SELECT page_id, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host, "
    f"split_part(CASE WHEN instr(bare, '/') > 0 THEN substr(bare, instr(bare, '/') + 1) WHEN instr(bare, '?') > 0 THEN substr(bare, instr(bare, '?')) ELSE bare END, '?', 1) AS path, "
    "nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page, nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref "
    f"FROM (SELECT *, {BARE} AS bare FROM pages) AS p",
)
def url_parts(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        fn.url_host("url").alias("host"),
        fn.url_path("url").alias("path"),
        fn.url_parameter("url", "page").alias("page"),
        fn.url_parameter("url", "ref").alias("ref"),
    )


@register(
    "url_host_counts",
    "SELECT split_part(split_part(replace(replace(url, 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host, count(*) AS pages FROM pages GROUP BY 1",
)
def url_host_counts(spark, d):
    return (
        table(spark, d, "pages").groupBy(fn.url_host("url").alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    )


@register(
    "date_functions",
    f"SELECT event_id, CAST(ts AS DATE) AS day, CAST(hour(ts) AS BIGINT) AS hour, CAST(month(ts) AS BIGINT) AS month, date_diff('hour', ts, {NOW}) AS hours, "
    f"date_diff('minute', ts, {NOW}) AS minutes, CAST(date_diff('day', ts, {NOW}) AS BIGINT) AS days, date_diff('microsecond', ts, {NOW}) / 3600000000.0 AS hours_exact, "
    "strftime(ts, '%Y-%m-%d %H:%M') AS label, CAST(CAST(ts AS DATE) - 7 AS DATE) AS week_before FROM events",
    "hours_exact",
    "hour month days",
)
def date_functions(spark, d):
    ts = F.col("ts")
    return table(spark, d, "events").select(
        "event_id",
        F.to_date(ts).alias("day"),
        F.hour(ts).alias("hour"),
        F.month(ts).alias("month"),
        times.boundaries("HOUR", ts, now()).alias("hours"),
        times.boundaries("MINUTE", ts, now()).alias("minutes"),
        times.boundaries("DAY", ts, now()).alias("days"),
        times.hours_between(ts, now()).alias("hours_exact"),
        times.minute_text(ts).alias("label"),
        F.date_sub(F.to_date(ts), 7).alias("week_before"),
    )


@register(
    "parse_times",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS parsed, date_trunc('second', ts) AS from_epoch FROM events",
)
def parse_times(spark, d):
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select(
        "event_id",
        times.parsed(text).cast("timestamp_ntz").alias("parsed"),
        times.from_epoch(seconds).cast("timestamp_ntz").alias("from_epoch"),
    )


@register(
    "round_texts",
    "SELECT c_custkey, printf('%.1f', c_acctbal) AS one, printf('%.2f', c_acctbal / 7) AS two FROM customer",
)
def round_texts(spark, d):
    return table(spark, d, "customer").select(
        "c_custkey",
        fn.fixed_point(F.col("c_acctbal"), 1).alias("one"),
        fn.fixed_point(F.col("c_acctbal") / 7, 2).alias("two"),
    )


@register(
    "json_roundtrip",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '{\"user\":' || user_id || ',\"type\":\"' || event_type || '\"}' AS doc FROM events",
)
def json_roundtrip(spark, d):
    return table(spark, d, "events").select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"))).alias("doc"),
    )


@register(
    "trimmed_texts",
    "SELECT doc_id, trim(lang) AS lang, nullif(trim(source), '') AS source, length(text) AS n FROM documents",
)
def trimmed_texts(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        F.trim("lang").alias("lang"),
        fn.null_if_empty(F.trim("source")).alias("source"),
        F.length("text").cast("bigint").alias("n"),
    )


@register(
    "deviation_from_mean",
    with_gold(
        "SELECT city, observation_time, temperature_celsius - avg(temperature_celsius) OVER (PARTITION BY city ORDER BY observation_time ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS deviation FROM gold"
    ),
    "deviation",
)
def deviation_from_mean(spark, d):
    from gaugeflow.plans.gold import trend_view

    return trend_view(gold(spark, d)).select(
        "city", "observation_time", (F.col("temperature_celsius") - F.col("rolling_24h_avg")).alias("deviation")
    )
