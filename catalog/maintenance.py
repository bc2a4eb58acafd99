"""Writing and maintaining tables: each query writes to the scratch folder and reads back."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.base import (
    AS_OF,
    NOW,
    RAW,
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
from catalog.layers import CLEAN, clean
from gaugeflow.plans import gold as plans
from gaugeflow.plans import incremental, metrics
from gaugeflow.plans.silver import score
from gaugeflow.runtime import scratch_path, written
from gaugeflow.sources import raw as raw_source
from gaugeflow.sources import layout, staging, storage
from gaugeflow.sources.schemas import TABLES

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def orders(spark, d):
    return table(spark, d, "orders").select(*ORDER_COLUMNS)


@register("insert_new", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def insert_new(spark, d):
    """Finished orders first, then all of them twice: each is kept once, as first loaded."""
    path = scratch_path(spark, "orders")
    rows = orders(spark, d).select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    storage.insert_new(rows.filter("o_orderstatus = 'F'").drop("o_orderstatus"), path, "o_orderkey", ["o_orderpriority"])
    changed = rows.withColumn(
        "o_totalprice", F.when(F.col("o_orderstatus") == "F", -1.0).otherwise(F.col("o_totalprice"))
    ).drop("o_orderstatus")
    for _ in range(2):
        storage.insert_new(changed, path, "o_orderkey", ["o_orderpriority"])
    return spark.read.parquet(path)


@register(
    "upsert",
    "SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders",
)
def upsert(spark, d):
    """All orders but some open ones, then new prices of all the open ones, twice."""
    path = scratch_path(spark, "orders")
    rows = orders(spark, d).select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    keys, parts = ["o_orderkey", "o_orderpriority"], ["o_orderpriority"]
    storage.upsert(
        rows.filter("o_orderstatus <> 'O' OR o_totalprice > 100000").drop("o_orderstatus"), path, keys, parts
    )
    update = rows.filter("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    for _ in range(2):
        storage.upsert(update.drop("o_orderstatus"), path, keys, parts)
    return spark.read.parquet(path).withColumn("o_orderpriority", F.col("o_orderpriority").cast("string"))


@register(
    "upsert_newest",
    with_raw(
        "SELECT source_city AS city, observation_time, ingestion_id, temperature FROM (SELECT *, row_number() OVER (PARTITION BY source_city, observation_time "
        "ORDER BY ingestion_time DESC, ingestion_id DESC) AS p FROM raw) AS r WHERE p = 1"
    ),
)
def upsert_newest(spark, d):
    """Corrections arrive before the first loads; the newest load still stays."""
    path = scratch_path(spark, "silver")
    flat = raw_source.flatten(raw(spark, d), "timestamp_ntz").select(
        F.col("source_city").alias("city"), "observation_time", "ingestion_time", "ingestion_id", "temperature"
    )
    for copy in (1, 0):
        batch = flat.filter(F.col("ingestion_id").endswith(f"-{copy}"))
        storage.upsert(batch, path, ["city", "observation_time"], [], newest=["ingestion_time", "ingestion_id"])
    return spark.read.parquet(path).drop("ingestion_time")


BOTH_DAILY = (
    "before AS (SELECT source_city AS city, CAST(observation_time AS DATE) AS observation_date, count(*) AS record_count, max(temperature) AS max_temperature FROM raw "
    "WHERE ingestion_id LIKE '%-0' AND temperature BETWEEN -50 AND 60 AND humidity BETWEEN 0 AND 100 AND pressure BETWEEN 800 AND 1100 AND wind_speed BETWEEN 0 AND 150 GROUP BY 1, 2), "
    "after AS (SELECT city, CAST(observation_time AS DATE) AS observation_date, count(*) AS record_count, max(temperature_celsius) AS max_temperature FROM clean WHERE is_valid GROUP BY 1, 2)"
)


@register(
    "write_gold_daily",
    f"WITH {RAW}, {CLEAN}, {BOTH_DAILY} SELECT * FROM after UNION ALL "
    "SELECT * FROM before WHERE (city, observation_date) NOT IN (SELECT city, observation_date FROM after)",
)
def write_gold_daily(spark, d):
    """The daily table, written before and after the correction of the readings.

    Days without a valid reading after the correction keep their first row.
    """
    path = scratch_path(spark, "daily")
    for rows in (gold(spark, d), clean(spark, d).filter("is_valid")):
        daily = plans.daily_view(rows).select("city", "observation_date", "record_count", "max_temperature")
        storage.write_gold(daily, path, ["observation_date"])
    return spark.read.parquet(path)


@register(
    "write_gold_events",
    with_gold(
        "SELECT city, observation_time, temperature_celsius FROM gold WHERE temperature_celsius > 35 OR wind_speed > 50 OR weather_main IN ('Thunderstorm', 'Rain')"
    ),
)
def write_gold_events(spark, d):
    path = scratch_path(spark, "events")
    found = plans.detected_events(gold(spark, d), now()).select("city", "observation_time", "temperature_celsius")
    for _ in range(2):
        storage.write_gold(found, path)
    storage.write_gold(found.filter("temperature_celsius > 1000"), path)  # empty: nothing happens
    return spark.read.parquet(path)


@register(
    "append_merging_schema",
    "SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer",
)
def append_merging_schema(spark, d):
    path = scratch_path(spark, "parties")
    storage.append(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), path)
    storage.append(
        table(spark, d, "customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
        ),
        path,
    )
    return storage.read_if_present(spark, path)


@register(
    "create_tables",
    with_silver("SELECT city, observation_time, temperature_celsius, is_valid FROM silver"),
)
def create_tables(spark, d):
    """Rows of the silver table after creating it, empty, with its schema, and filling it."""
    path, kind = scratch_path(spark, "silver"), TABLES["silver"]
    storage.create_table(spark, "silver", path)
    rows = silver(spark, d).withColumn("observation_time", F.col("observation_time").cast("timestamp"))
    rows = rows.withColumn("processed_time", F.col("processed_time").cast("timestamp"))
    columns = storage.create_table(spark, "silver", path).drop(*kind.derived).columns
    storage.append(rows.select(*columns), path, kind.partition_by, kind.derived, kind.order)
    kept = storage.create_table(spark, "silver", path)
    return kept.select(
        "city", F.col("observation_time").cast("timestamp_ntz").alias("observation_time"), "temperature_celsius", "is_valid"
    )


@register(
    "compacted",
    with_silver("SELECT city, observation_time, temperature_celsius, weather_main FROM obs"),
)
def compacted(spark, d):
    path, target = scratch_path(spark, "silver"), scratch_path(spark, "silver-compact")
    rows = observations(spark, d).select("city", "observation_time", "temperature_celsius", "weather_main")
    storage.append(rows.repartition(16), path)
    storage.compact(spark, path, target, ["city", "observation_time"], ["weather_main"])
    return spark.read.parquet(target)


@register(
    "curve_clustered",
    with_silver("SELECT count(*) AS \"rows\", TRUE AS city_skips, TRUE AS time_skips, TRUE AS linear_time_does_not FROM obs"),
)
def curve_clustered(spark, d):
    """Files read for one city and for one time, on the curve and sorted by city first: the mean share of a file's span."""
    path, target = scratch_path(spark, "silver"), scratch_path(spark, "silver-curve")
    rows = observations(spark, d).select("city", "observation_time", "temperature_celsius")
    storage.append(rows, path)
    size = layout.files_of(spark, path).agg(F.sum("length")).first()[0]
    layout.cluster(spark, path, ["city", "observation_time"], target=target, file_bytes=max(1, size // 16))
    sorted_path = scratch_path(spark, "silver-sorted")
    storage.append(rows.repartitionByRange(16, "city", "observation_time"), sorted_path)
    ranked = rows.select("city").distinct().withColumn("at", F.dense_rank().over(Window.orderBy("city")))  # one row a city
    place = lambda side: ranked.select(F.col("city").alias(f"{side}_city"), F.col("at").alias(f"{side}_at"))
    seconds = lambda side: F.col(f"{side}_observation_time").cast("timestamp").cast("double")

    def shares(p):
        """Mean share of a file's span in that of the table, by city and by time."""
        files = layout.spans(spark.read.parquet(p), ["city", "observation_time"]).join(place("min"), "min_city").join(place("max"), "max_city")
        return files.agg(
            F.sum("rows").alias("rows"),
            (F.avg(F.col("max_at") - F.col("min_at")) / (F.max("max_at") - F.min("min_at"))).alias("c"),
            (F.avg(seconds("max") - seconds("min")) / (F.max(seconds("max")) - F.min(seconds("min")))).alias("t"),
        )

    curve, linear = shares(target).first(), shares(sorted_path).first()  # one row each
    found = (curve["rows"], curve["c"] < 0.5, curve["t"] < 0.5, linear["t"] > 0.9)
    return spark.createDataFrame([found], "rows bigint, city_skips boolean, time_skips boolean, linear_time_does_not boolean")


@register(
    "packed",
    with_silver(
        "SELECT weather_main, count(*) AS \"rows\", CAST(1 AS BIGINT) AS files, CASE WHEN weather_main = 'Rain' THEN 0 ELSE 8 END AS gone, 0 AS gone_again "
        "FROM obs GROUP BY weather_main"
    ),
)
def packed(spark, d):
    """Eight small files a folder and one large one: the small ones become one each, repeating it finds nothing."""
    path = scratch_path(spark, "silver-small")
    rows = observations(spark, d).select("city", "observation_time", "temperature_celsius", "weather_main")
    rows.filter("weather_main <> 'Rain'").repartition(8).write.partitionBy("weather_main").parquet(path)
    rows.filter("weather_main = 'Rain'").coalesce(1).write.mode("append").partitionBy("weather_main").parquet(path)
    before = spark.read.parquet(path).groupBy("weather_main").agg(F.collect_set("_metadata.file_path").alias("old"))
    before = written(before, "files")  # eight paths a folder
    layout.pack(spark, path, ["weather_main"])
    again = layout.pack(spark, path, ["weather_main"])
    after = spark.read.parquet(path).groupBy("weather_main").agg(F.count(F.lit(1)).alias("rows"), F.collect_set("_metadata.file_path").alias("new"))
    return after.join(before, "weather_main").select(
        "weather_main", "rows", F.size("new").cast("bigint").alias("files"), F.size(F.array_except("old", "new")).alias("gone"), F.lit(again).alias("gone_again")
    )


@register(
    "dataset_profile",
    "SELECT CAST(1 AS BIGINT) AS num_files, count(*) AS num_records FROM lineitem",
)
def dataset_profile(spark, d):
    return storage.dataset_profile(table(spark, d, "lineitem")).select("num_files", "num_records")


@register(
    "retention_applied",
    with_raw(f"SELECT ingestion_id, source_city FROM raw WHERE ingestion_time >= {NOW} - INTERVAL 10 DAY"),
)
def retention_applied(spark, d):
    path = scratch_path(spark, "raw")
    day = F.to_date("ingestion_time").alias("loaded")
    storage.append(raw(spark, d).select("ingestion_id", "ingestion_time", "source_city", day), path, ["loaded"])
    storage.apply_retention(spark, path, "ingestion_time", 10, AS_OF, ["loaded"])
    return spark.read.parquet(path).select("ingestion_id", "source_city")


def points(spark, d):
    from catalog.health import series

    return series(spark, d).withColumn(
        "tags", F.map_concat("tags", F.create_map(F.lit("part"), F.when(F.hour("timestamp") < 12, "am").otherwise("pm")))
    )


@register(
    "export_csv",
    with_silver(
        "SELECT 'temperature.' || weather_main AS name, temperature_celsius AS value, observation_time AS timestamp, 'celsius' AS unit, city, "
        "CASE WHEN hour(observation_time) < 12 THEN 'am' ELSE 'pm' END AS part FROM silver"
    ),
)
def export_csv(spark, d):
    path = scratch_path(spark, "metrics-csv")
    storage.export_metrics(points(spark, d), path, "csv", ["city", "part"])
    schema = "name string, value double, timestamp timestamp_ntz, unit string, city string, part string"
    return spark.read.schema(schema).options(header="true", **storage.CSV_TIMES).csv(path)


@register(
    "export_json",
    with_silver(
        "SELECT 'temperature.' || weather_main AS name, temperature_celsius AS value, 'celsius' AS unit, city FROM silver"
    ),
)
def export_json(spark, d):
    path = scratch_path(spark, "metrics-json")
    storage.export_metrics(points(spark, d), path, "json")
    schema = "name string, value double, timestamp string, tags map<string,string>, unit string"
    return spark.read.schema(schema).json(path).select("name", "value", "unit", F.col("tags")["city"].alias("city"))


@register(
    "bound_sql",
    with_gold("SELECT city, count(*) AS readings, max(temperature_celsius) AS hottest FROM gold WHERE humidity >= 50 AND weather_main = 'Rain' GROUP BY 1"),
)
def bound_sql(spark, d):
    return storage.query(
        spark,
        "SELECT city, count(*) AS readings, max(temperature_celsius) AS hottest FROM gf_gold "
        "WHERE humidity >= :humidity AND weather_main = :condition GROUP BY city",
        {"gf_gold": gold(spark, d)},
        humidity=50,
        condition="Rain",
    )


@register(
    "model_views",
    with_gold("SELECT observation_date, count(DISTINCT city) AS cities FROM gold GROUP BY 1"),
)
def model_views(spark, d):
    """A view over a view over a table."""
    storage.materialise(plans.with_date(gold(spark, d)), "gf_staged", "table", scratch_path(spark, "staged"))
    storage.materialise(spark.table("gf_staged").select("observation_date", "city").distinct(), "gf_days")
    return spark.table("gf_days").groupBy("observation_date").agg(F.count("city").alias("cities"))


def file_points(t: str) -> str:
    return (
        f"SELECT 'delta.{t}.num_files' AS name, CAST(1 AS DOUBLE) AS value, 'files' AS unit UNION ALL "
        f"SELECT 'delta.{t}.num_records', CAST(count(*) AS DOUBLE), 'records' FROM {t}"
    )


@register("upsert_replay", with_raw("SELECT ingestion_id, source_city AS city, CASE WHEN ingestion_id LIKE '%7-0' THEN NULL ELSE observation_time END AS observation_time FROM raw WHERE ingestion_id LIKE '%-0'"))
def upsert_replay(spark, d):
    """The same load three times, some readings without a time: it counts once."""
    path = scratch_path(spark, "replay")
    flat = raw_source.flatten(raw(spark, d), "timestamp_ntz").filter(F.col("ingestion_id").endswith("-0"))
    time = F.when(~F.col("ingestion_id").endswith("7-0"), F.col("observation_time"))
    rows = flat.select("ingestion_id", F.col("source_city").alias("city"), time.alias("observation_time"))
    for _ in range(3):
        storage.upsert(
            rows, path, ["city", "observation_time"], ["observation_date"], ["ingestion_id"],
            derived={"observation_date": F.to_date("observation_time")},
        )
    return spark.read.parquet(path).drop("observation_date")


@register("insert_replay", "SELECT CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey, o_orderpriority, o_totalprice FROM orders")
def insert_replay(spark, d):
    """The same load three times, every third order without its key: it counts once."""
    path = scratch_path(spark, "replay")
    key = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("o_orderkey")
    for _ in range(3):
        storage.insert_new(table(spark, d, "orders").select(key, "o_orderpriority", "o_totalprice"), path, "o_orderkey", ["o_orderpriority"])
    return spark.read.parquet(path).withColumn("o_orderpriority", F.col("o_orderpriority").cast("string"))


CLEAN_STATS = (
    "stats AS (SELECT s.*, m.most_common_weather FROM (SELECT city, CAST(observation_time AS DATE) AS observation_date, CAST(count(*) AS BIGINT) AS hourly_readings, "
    "avg(temperature_celsius) AS avg_temp, max(temperature_celsius) AS max_temp, min(temperature_celsius) AS min_temp, avg(humidity) AS avg_humidity, "
    "avg(wind_speed) AS avg_wind_speed FROM clean WHERE is_valid GROUP BY 1, 2) AS s JOIN ("
    + mode_sql("(SELECT *, CAST(observation_time AS DATE) AS observation_date FROM clean WHERE is_valid) AS v", "city, observation_date", "weather_main", "most_common_weather")
    + ") AS m ON s.city = m.city AND s.observation_date = m.observation_date)"
)


def loaded(spark, d, results=None):
    """Readings in two loads, the corrections of every other reading first; where the tables of readings and of states stand."""
    flat = raw_source.flatten(raw(spark, d), "timestamp_ntz").withColumnRenamed("temperature", "temperature_celsius")
    rows = score(flat.withColumnRenamed("source_city", "city")).drop("raw_payload")
    number = F.regexp_extract("ingestion_id", "^([0-9]+)-", 1).cast("bigint")
    early = F.when(number % 2 == 0, F.col("ingestion_id").endswith("-1")).otherwise(F.col("ingestion_id").endswith("-0"))
    readings, states = scratch_path(spark, "readings"), scratch_path(spark, "states")
    for part in (early, ~early):
        incremental.load(rows.filter(part), readings, states, results=results)
    return readings, states


@register("mart_incremental", f"WITH {RAW}, {CLEAN}, {CLEAN_STATS} SELECT * FROM stats", "avg_temp avg_humidity avg_wind_speed", "hourly_readings")
def mart_incremental(spark, d):
    """The daily mart from states that two loads, one of them of corrections, were merged into."""
    _, states = loaded(spark, d)
    return incremental.daily(staging.read(spark, states))


@register(
    "averages_incremental",
    f"WITH {RAW}, {CLEAN} SELECT city, observation_time, temperature_celsius, CASE WHEN count(*) OVER d = 24 THEN avg(temperature_celsius) OVER d END AS ma_24h, "
    "CASE WHEN count(*) OVER w = 168 THEN avg(temperature_celsius) OVER w END AS ma_7d FROM clean WHERE is_valid "
    "WINDOW d AS (PARTITION BY city ORDER BY observation_time ROWS 23 PRECEDING), w AS (PARTITION BY city ORDER BY observation_time ROWS 167 PRECEDING)",
    "ma_24h ma_7d",
)
def averages_incremental(spark, d):
    """Averages over 24 and 168 readings, kept up to date over the same loads."""
    path = scratch_path(spark, "averages")
    loaded(spark, d, {path: (plans.full_moving_averages, [("rows", 168)])})
    return staging.read(spark, path).drop("observation_date")


@register("insert_indexed", "SELECT o_orderkey, o_totalprice FROM orders")
def insert_indexed(spark, d):
    """Orders in four loads, the last one again: only files that may hold one of a load's keys are opened."""
    path = scratch_path(spark, "orders-indexed")
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    for part in (0, 1, 2, 3, 3):
        storage.insert_new(rows.filter(F.col("o_orderkey") % 4 == part), path, "o_orderkey", indexed=True)
    return spark.read.parquet(path)


@register("table_metrics", f"{file_points('events')} UNION ALL {file_points('orders')}")
def table_metrics(spark, d):
    """Files and rows of two tables as metric points; bytes are left out of the comparison."""
    points = metrics.table_metrics({t: table(spark, d, t) for t in ("events", "orders")}, AS_OF)
    return points.filter("unit <> 'bytes'").select("name", "value", "unit")
