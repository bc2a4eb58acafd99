"""Data tests; each query gives the rows that fail."""

from pyspark.sql import functions as F

from catalog.base import AS_OF, NOW, TODAY, gold, observations, register, silver, table, with_gold, with_silver
from gaugeflow.operators import checks
from gaugeflow.plans import health
from gaugeflow.runtime import scratch_path
from gaugeflow.sources import storage

WEEK = f"observation_time >= {TODAY} - INTERVAL 7 DAY"


@register(
    "check_accepted_range",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_totalprice >= 10000 AND o_totalprice <= 400000)",
)
def accepted_range(spark, d):
    return checks.accepted_range(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10000, 400000)


@register(
    "check_accepted_range_exclusive",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT (l_quantity > 1 AND l_quantity < 50)",
)
def accepted_range_exclusive(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return checks.accepted_range(rows, "l_quantity", 1, 50, inclusive=False)


@register(
    "check_at_least_one",
    "SELECT c_custkey, count(price) AS non_null FROM (SELECT c_custkey, CASE WHEN o_totalprice > 300000 THEN o_totalprice END AS price "
    "FROM customer LEFT JOIN orders ON o_custkey = c_custkey) AS x GROUP BY 1 HAVING count(price) = 0",
)
def at_least_one(spark, d):
    high = table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_totalprice") > 300000, F.col("o_totalprice")).alias("price")
    )
    joined = table(spark, d, "customer").select("c_custkey").join(high, "c_custkey", "left")
    return checks.at_least_one(joined, "price", ["c_custkey"])


@register(
    "check_cardinality_equality",
    "WITH a AS (SELECT c_custkey AS value, count(*) AS num_rows FROM customer GROUP BY 1), b AS (SELECT o_custkey AS value, count(*) AS num_rows FROM orders GROUP BY 1) "
    "(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)",
)
def cardinality_equality(spark, d):
    return checks.cardinality_equality(table(spark, d, "customer"), "c_custkey", table(spark, d, "orders"), "o_custkey")


COUNTS = (
    "SELECT l_returnflag, count_a, count_b, {delta} FROM (SELECT l_returnflag, count(*) AS count_a FROM lineitem WHERE l_quantity > 25 GROUP BY 1) AS a "
    "FULL JOIN (SELECT l_returnflag, count(*) AS count_b FROM lineitem WHERE l_discount > 0.04 GROUP BY 1) AS b USING (l_returnflag)"
)


def halves(spark, d):
    rows = table(spark, d, "lineitem")
    return rows.filter("l_quantity > 25"), rows.filter("l_discount > 0.04")


@register(
    "check_equal_rowcount",
    f"SELECT * FROM ({COUNTS.format(delta='abs(count_a - count_b) AS diff_count')}) AS x WHERE diff_count > 0",
)
def equal_rowcount(spark, d):
    a, b = halves(spark, d)
    return checks.equal_rowcount(a, b, ["l_returnflag"])


@register(
    "check_equal_rowcount_whole",
    "SELECT (SELECT count(*) FROM orders) AS count_a, (SELECT count(*) FROM lineitem) AS count_b, abs((SELECT count(*) FROM orders) - (SELECT count(*) FROM lineitem)) AS diff_count",
)
def equal_rowcount_whole(spark, d):
    return checks.equal_rowcount(table(spark, d, "orders"), table(spark, d, "lineitem"))


@register(
    "check_fewer_rows_than",
    "SELECT * FROM ("
    + COUNTS.format(
        delta="CAST(CASE WHEN count_a > count_b THEN count_a - count_b WHEN count_a = count_b THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta"
    ).replace("l_quantity > 25", "l_quantity > 15")
    + ") AS x WHERE row_count_delta > 0",
)
def fewer_rows_than(spark, d):
    rows = table(spark, d, "lineitem")
    return checks.fewer_rows_than(rows.filter("l_quantity > 15"), rows.filter("l_discount > 0.04"), ["l_returnflag"])


@register(
    "check_equality",
    "WITH a AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A') "
    "SELECT *, 'model' AS only_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b) AS x UNION ALL SELECT *, 'compare' AS only_in FROM (SELECT * FROM b EXCEPT SELECT * FROM a) AS y",
)
def equality(spark, d):
    rows = table(spark, d, "lineitem")
    return checks.equality(
        rows.filter("l_returnflag = 'R'"), rows.filter("l_returnflag = 'A'"), ["l_partkey", "l_suppkey"]
    )


@register(
    "check_expression_is_true",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE NOT (l_extendedprice * (1 - l_discount) < 50000)",
)
def expression_is_true(spark, d):
    rows = table(spark, d, "lineitem")
    return checks.expression_is_true(rows, "l_extendedprice * (1 - l_discount) < 50000").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )


def ranges_sql(proper: str, meets: str) -> str:
    """The last range is the one no other follows, also where equal ranges tie."""
    return (
        "SELECT * EXCLUDE (is_last) FROM (SELECT o_custkey, lo AS lower_bound, hi AS upper_bound, lead(lo) OVER (PARTITION BY o_custkey ORDER BY lo, hi) AS next_lower_bound, "
        "lead(1) OVER (PARTITION BY o_custkey ORDER BY lo, hi) IS NULL AS is_last FROM "
        "(SELECT o_custkey, o_orderdate AS lo, o_orderdate + CAST(floor(o_totalprice) AS BIGINT) % 400 * INTERVAL 1 DAY AS hi FROM orders) AS r) AS w "
        f"WHERE NOT (coalesce(lower_bound {proper} upper_bound, FALSE) AND coalesce(upper_bound {meets} next_lower_bound, is_last, FALSE))"
    )


def ranges(spark, d):
    days = F.floor("o_totalprice").cast("bigint") % 400
    return table(spark, d, "orders").select(
        "o_custkey",
        F.col("o_orderdate").alias("lo"),
        (F.col("o_orderdate") + days * F.expr("INTERVAL 1 DAY")).alias("hi"),
    )


@register("check_ranges_gaps_allowed", ranges_sql("<", "<="))
def ranges_gaps_allowed(spark, d):
    return checks.mutually_exclusive_ranges(ranges(spark, d), "lo", "hi", ["o_custkey"])


@register("check_ranges_gaps_required", ranges_sql("<=", "<"))
def ranges_gaps_required(spark, d):
    return checks.mutually_exclusive_ranges(ranges(spark, d), "lo", "hi", ["o_custkey"], "required", zero_length=True)


@register("check_ranges_gaps_not_allowed", ranges_sql("<", "="))
def ranges_gaps_not_allowed(spark, d):
    return checks.mutually_exclusive_ranges(ranges(spark, d), "lo", "hi", ["o_custkey"], "not_allowed")


@register(
    "check_not_accepted_values",
    "SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error', 'signup', 'unknown')",
)
def not_accepted_values(spark, d):
    return checks.not_accepted_values(table(spark, d, "events"), "event_type", ["error", "signup", "unknown"])


@register(
    "check_accepted_values",
    "SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1",
)
def accepted_values(spark, d):
    return checks.accepted_values(table(spark, d, "events"), "event_type", ["click", "view"])


@register(
    "check_not_constant",
    "SELECT o_custkey, CAST(1 AS BIGINT) AS filler_column FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 1",
)
def not_constant(spark, d):
    return checks.not_constant(table(spark, d, "orders"), "o_orderstatus", ["o_custkey"])


@register(
    "check_not_empty_string",
    "SELECT page_id, fragment FROM (SELECT page_id, CASE WHEN contains(url, '?') THEN url ELSE '  ' END AS fragment FROM pages) AS p WHERE trim(fragment) = ''",
)
def not_empty_string(spark, d):
    rows = table(spark, d, "pages").select(
        "page_id", F.when(F.contains("url", F.lit("?")), F.col("url")).otherwise(F.lit("  ")).alias("fragment")
    )
    return checks.not_empty_string(rows, "fragment")


LABELLED = "(SELECT d.doc_id, d.lang, d.source, l.quality FROM documents AS d LEFT JOIN labels AS l USING (doc_id)) AS x"


def labelled(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")


@register("check_not_null", f"SELECT doc_id, lang, source, quality FROM {LABELLED} WHERE quality IS NULL")
def not_null(spark, d):
    return checks.not_null(labelled(spark, d), "quality")


@register(
    "check_not_null_proportion",
    f"SELECT * FROM (SELECT lang, CAST(count(quality) AS DOUBLE) / count(*) AS not_null_proportion FROM {LABELLED} GROUP BY 1) AS p WHERE not_null_proportion < 0.9",
    "not_null_proportion",
)
def not_null_proportion(spark, d):
    return checks.not_null_proportion(labelled(spark, d), "quality", 0.9, group_by=["lang"])


@register(
    "check_recency",
    f"SELECT * FROM (SELECT user_id, max(ts) AS most_recent, {NOW} - INTERVAL 12 HOUR AS threshold FROM events GROUP BY 1) AS r WHERE most_recent < threshold",
)
def recency(spark, d):
    return checks.recency(table(spark, d, "events"), "ts", "hour", 12, AS_OF, group_by=["user_id"])


@register(
    "check_recency_by_date",
    f"SELECT * FROM (SELECT user_id, CAST(max(ts) AS DATE) AS most_recent, {TODAY} - 1 AS threshold FROM events GROUP BY 1) AS r WHERE most_recent < threshold",
)
def recency_by_date(spark, d):
    return checks.recency(table(spark, d, "events"), "ts", "day", 1, AS_OF, ignore_time=True, group_by=["user_id"])


@register(
    "check_relationships_where",
    "SELECT o_custkey, count(*) AS failing_rows FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1",
)
def relationships_where(spark, d):
    return checks.relationships_where(
        table(spark, d, "orders"),
        "o_custkey",
        table(spark, d, "customer"),
        "c_custkey",
        "o_orderstatus = 'F'",
        "c_acctbal > 0",
    )


@register(
    "check_sequential_values",
    "SELECT o_custkey, o_orderkey, prev AS previous_o_orderkey, CAST(1 AS BIGINT) AS failing_rows FROM "
    "(SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prev FROM orders) AS x WHERE NOT (o_orderkey = prev + 1)",
)
def sequential_values(spark, d):
    return checks.sequential_values(table(spark, d, "orders"), "o_orderkey", group_by=["o_custkey"])


@register(
    "check_sequential_times",
    "SELECT min(day) AS day, previous_day, sum(bad) AS failing_rows FROM (SELECT day, lag(day) OVER (ORDER BY day) AS prev FROM (SELECT o_orderdate AS day FROM orders) AS o) AS l, "
    "LATERAL (SELECT CASE WHEN prev IS NOT NULL AND day <> prev + INTERVAL 1 DAY THEN 1 ELSE 0 END AS bad, (SELECT max(o_orderdate) FROM orders AS q WHERE q.o_orderdate < l.day) AS previous_day) AS x "
    "GROUP BY day, previous_day HAVING sum(bad) > 0",
    big="failing_rows",
)
def sequential_times(spark, d):
    days = table(spark, d, "orders").select(F.col("o_orderdate").alias("day"))
    return checks.sequential_values(days, "day", 1, "day")


@register(
    "check_unique_combination",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def unique_combination(spark, d):
    return checks.unique_combination(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("check_unique", "SELECT url, count(*) AS n_records FROM (SELECT split_part(url, '/', 3) AS url FROM pages) AS p GROUP BY 1 HAVING count(*) > 1")
def unique(spark, d):
    return checks.unique(table(spark, d, "pages").select(F.split_part("url", F.lit("/"), F.lit(3)).alias("url")), "url")


@register(
    "check_is_json",
    "SELECT event_id, body FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN '{' || props ELSE props END AS body FROM events) AS e WHERE NOT json_valid(body)",
)
def is_json(spark, d):
    body = F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    return checks.is_json(table(spark, d, "events").select("event_id", body.alias("body")), "body")


@register(
    "check_humidity_range",
    with_silver("SELECT city, observation_time, humidity FROM (SELECT city, observation_time, humidity * 2 - 20 AS humidity FROM obs) AS o WHERE humidity < 0 OR humidity > 100"),
)
def humidity_range(spark, d):
    return health.humidity_range(observations(spark, d).withColumn("humidity", F.col("humidity") * 2 - 20))


@register(
    "check_temperature_range",
    with_silver("SELECT city, observation_time, temperature_celsius FROM obs WHERE temperature_celsius < -50 OR temperature_celsius > 60"),
)
def temperature_range(spark, d):
    return health.temperature_range(silver(spark, d))


@register(
    "check_duplicate_readings",
    "SELECT city, observation_time, count(*) AS duplicate_count FROM (SELECT o_custkey AS city, o_orderdate AS observation_time FROM orders) AS o GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_readings(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_custkey").alias("city"), F.col("o_orderdate").alias("observation_time")
    )
    return health.duplicate_readings(rows)


@register(
    "check_jumps",
    with_gold(
        "SELECT city, observation_time, temperature_celsius, prev AS prev_temp, abs(temperature_celsius - prev) AS temp_change FROM "
        f"(SELECT *, lag(temperature_celsius) OVER (PARTITION BY city ORDER BY observation_time) AS prev FROM gold WHERE {WEEK}) AS g WHERE abs(temperature_celsius - prev) > 15"
    ),
    "temp_change",
)
def jumps(spark, d):
    return health.jumps(gold(spark, d), as_of=AS_OF)


@register(
    "check_seasonal_pattern",
    with_gold(
        "SELECT * FROM (SELECT *, CASE WHEN month IN (6, 7, 8) AND avg_temp < 10 THEN 'Unusually Cold Summer' WHEN month IN (12, 1, 2) AND avg_temp > 15 THEN 'Unusually Warm Winter' "
        "WHEN month IN (3, 4, 5) AND avg_temp < 0 THEN 'Unusually Cold Spring' WHEN month IN (9, 10, 11) AND avg_temp > 25 THEN 'Unusually Warm Autumn' ELSE 'Normal Season' END AS seasonal_anomaly FROM "
        "(SELECT city, CAST(extract(month FROM observation_time) AS INTEGER) AS month, count(*) AS sample_size, avg(temperature_celsius) AS avg_temp, avg(humidity) AS avg_humidity FROM gold "
        f"WHERE observation_time >= {TODAY} - INTERVAL 90 DAY GROUP BY 1, 2) AS s) AS t WHERE seasonal_anomaly <> 'Normal Season'"
    ),
    "avg_temp avg_humidity",
)
def seasonal_pattern(spark, d):
    return health.seasonal_anomalies(gold(spark, d), as_of=AS_OF)


@register(
    "check_coverage",
    with_gold(
        "SELECT *, CASE WHEN reading_count = 0 THEN 'No Data' WHEN reading_count < 12 THEN 'Partial Data' ELSE 'Complete Data' END AS coverage_status FROM "
        "(SELECT k.city, count(g.city) AS reading_count, max(g.observation_time) AS latest_reading FROM (SELECT DISTINCT city FROM obs) AS k LEFT JOIN "
        f"(SELECT * FROM gold WHERE observation_time >= {NOW} - INTERVAL 24 HOUR) AS g ON g.city = k.city GROUP BY 1) AS c WHERE reading_count < 12"
    ),
)
def coverage(spark, d):
    return health.poor_coverage(gold(spark, d), 24, AS_OF, observations(spark, d))


TESTS = {
    "temperature_range": "SELECT count(*) FROM obs WHERE temperature_celsius < -50 OR temperature_celsius > 60",
    "humidity_range": "SELECT count(*) FROM obs WHERE humidity < 0 OR humidity > 100",
    "duplicates": "SELECT count(*) FROM (SELECT 1 FROM obs GROUP BY city, observation_time HAVING count(*) > 1) AS q",
    "city_not_null": "SELECT count(*) FROM obs WHERE city IS NULL",
    "hot_in_range": "SELECT count(*) FROM obs WHERE temperature_celsius > 35",
    "partners": "SELECT count(*) FROM obs WHERE weather_main NOT IN (SELECT weather_main FROM obs WHERE weather_main <> 'Rain')",
    "sequence": "SELECT count(*) FROM (SELECT humidity - lag(humidity) OVER (PARTITION BY city ORDER BY humidity) AS step FROM obs WHERE humidity IS NOT NULL) AS q WHERE step <> 1",
    "equal": "SELECT count(*) + abs(sum(side)) FROM (SELECT 1 AS side FROM (SELECT DISTINCT city, humidity FROM obs EXCEPT SELECT city, humidity FROM obs WHERE humidity > 50) AS a)",
}


@register(
    "check_run",
    with_silver(
        " UNION ALL ".join(
            f"SELECT '{n}' AS test, CAST(failures AS BIGINT) AS failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'warn' END AS status FROM (SELECT ({q}) AS failures) AS x"
            for n, q in TESTS.items()
        )
    ),
)
def run(spark, d):
    rows = silver(spark, d)
    return checks.run_checks(
        {
            "temperature_range": health.temperature_range(rows),
            "humidity_range": health.humidity_range(rows),
            "duplicates": health.duplicate_readings(rows),
            "partners": checks.relationships_where(
                rows, "weather_main", rows, "weather_main", to_condition="weather_main <> 'Rain'"
            ),
            "sequence": checks.sequential_values(rows, "humidity", group_by=["city"]),
            "equal": checks.equality(rows, rows.filter("humidity > 50"), ["city", "humidity"]),
        }
    ).unionByName(
        checks.run_row_checks(
            rows, {"city_not_null": F.col("city").isNotNull(), "hot_in_range": F.col("temperature_celsius") <= 35}
        )
    )


@register(
    "check_stored_failures",
    with_silver("SELECT city, observation_time, temperature_celsius FROM obs WHERE temperature_celsius < -50 OR temperature_celsius > 60"),
)
def stored_failures(spark, d):
    places = checks.store_failures({"temperature_range": health.temperature_range(silver(spark, d))})
    return spark.read.parquet(places["temperature_range"])


BUNDLE = "SELECT '{name}' AS part, count(*) AS lines FROM ({sql}) AS q"


@register(
    "validation_bundles",
    with_gold(
        " UNION ALL ".join(
            BUNDLE.format(name=n, sql=q)
            for n, q in {
                "gold.missing": f"SELECT city FROM gold WHERE observation_date >= {TODAY} - INTERVAL 7 DAY GROUP BY 1",
                "gold.freshness": "SELECT city FROM gold GROUP BY 1",
                "gold.events": "SELECT city, CASE WHEN temperature_celsius > 35 THEN 'h' WHEN wind_speed > 50 OR weather_main = 'Thunderstorm' THEN 's' ELSE 'r' END AS e FROM gold "
                "WHERE temperature_celsius > 35 OR wind_speed > 50 OR weather_main IN ('Thunderstorm', 'Rain') GROUP BY 1, 2",
                "silver.statistics": "SELECT city FROM silver GROUP BY 1",
                "silver.invalid": "SELECT city FROM silver WHERE NOT is_valid GROUP BY city, quality_checks_passed",
                "silver.trend": "SELECT CAST(observation_time AS DATE) AS d FROM silver GROUP BY 1 ORDER BY 1 DESC LIMIT 7",
            }.items()
        )
    ),
)
def validation_bundles(spark, d):
    from gaugeflow.plans import gold as plans

    rows = gold(spark, d)
    parts = {f"gold.{n}": f for n, f in health.gold_validation(plans.daily_view(rows), plans.detected_events(rows), 7, AS_OF).items()}
    parts |= {f"silver.{n}": f for n, f in health.silver_validation(silver(spark, d)).items()}
    out = None
    for n, f in parts.items():
        line = f.agg(F.count(F.lit(1)).alias("lines")).select(F.lit(n).alias("part"), "lines")
        out = line if out is None else out.unionByName(line)
    return out


@register(
    "check_while_writing",
    with_silver(
        "SELECT 'hot' AS test, count(*) FILTER (WHERE temperature_celsius > 40) AS failures, CASE WHEN count(*) FILTER (WHERE temperature_celsius > 40) = 0 THEN 'pass' ELSE 'warn' END AS status, "
        "count(*) AS written FROM silver UNION ALL "
        "SELECT 'valid', count(*) FILTER (WHERE NOT is_valid), CASE WHEN count(*) FILTER (WHERE NOT is_valid) = 0 THEN 'pass' ELSE 'warn' END, count(*) FROM silver UNION ALL "
        "SELECT 'named', 0, 'pass', count(*) FROM silver"
    ),
)
def check_while_writing(spark, d):
    """Row checks counted in the write of the table itself."""
    watched = checks.Watched(
        silver(spark, d), {"hot": F.col("temperature_celsius") <= 40, "valid": F.col("is_valid"), "named": F.col("city").isNotNull()}
    )
    storage.append(watched.rows, scratch_path(spark, "checked"))
    return watched.result().withColumn("written", F.lit(watched.rows_written).cast("bigint"))
