"""Layers, plans and storage on small tables."""

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from conftest import CITIES, rows
from pyspark.sql import functions as F

from gaugeflow.operators.grouping import summarise
from gaugeflow.plans import declared, gold, health, marts, metrics, reports
from gaugeflow.plans import silver as silver_plans
from gaugeflow.runtime import scratch_path
from gaugeflow.sources import raw, storage
from gaugeflow.sources.schemas import TABLES
from gaugeflow.spec import split_at

NOW = "2024-01-02 00:00:00"


def test_api_payload(spark):
    doc = (
        '{"main":{"temp":18.5,"humidity":65,"pressure":1012},"wind":{"speed":4.2},'
        '"weather":[{"main":"Clouds","description":"scattered clouds"}],"dt":1718899200}'
    )
    got = raw.from_api(spark.createDataFrame([("London", doc), ("Paris", "{bad")], "key string, body string"), "body", "key")
    line = got.filter("city = 'London'").withColumn("timestamp", F.col("timestamp").cast("string")).first()
    assert tuple(line) == ("London", 18.5, 65, 1012, 4.2, "Clouds", "scattered clouds", "2024-06-20 16:00:00")
    assert got.filter("city = 'Paris' AND temperature IS NULL AND weather_main IS NULL").count() == 1


def test_record_validation(spark):
    data = [(t, 50) for t in (-10.0, 0.0, 15.0, 30.0, 45.0)] + [(100.0, 50), (20.0, 101), (None, 5)]
    accepted, rejected = silver_plans.validate(spark.createDataFrame(data, "temperature_celsius double, humidity int"))
    assert (accepted.count(), rejected.count()) == (5, 3)


def payloads(spark):
    good = '{"city":"Oslo","temperature":%s,"humidity":%s,"pressure":1000,"wind_speed":3.0,"weather_main":"Rain","weather_description":"rain","timestamp":"%s"}'
    t = "2024-01-01T10:00:00"
    data = [
        ("1", datetime(2024, 1, 1, 11), good % ("1.5", "50", t)),
        ("2", datetime(2024, 1, 1, 12), good % ("2.5", "50", t)),  # later load of the same reading
        ("3", datetime(2024, 1, 1, 12), good % ("70.0", "65.5", "2024-01-01T11:00:00")),  # out of range; not an int
        ("4", datetime(2024, 1, 1, 12), good % ("3.0", "50", "no time")),
        ("5", datetime(2023, 12, 1, 12), good % ("3.0", "50", "2023-12-01T10:00:00")),  # too old for an increment
    ]
    df = spark.createDataFrame(data, "ingestion_id string, ingestion_time timestamp, raw_payload string")
    return df.withColumns({"source_city": F.lit("Oslo"), "source": F.lit("api"), "api_response_time": F.lit(0.1)})


def test_clean(spark):
    got = silver_plans.clean(raw.scan_increment(payloads(spark)))
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == TABLES["silver"].schema.split(", ")
    lines = {r["ingestion_id"]: r for r in got.collect()}
    assert set(lines) == {"2", "3", "4"}
    assert lines["2"]["temperature_celsius"] == 2.5 and lines["2"]["is_valid"]
    assert lines["3"]["humidity"] is None and lines["3"]["quality_checks_passed"] == 3 and not lines["3"]["is_valid"]
    assert lines["4"]["observation_time"] is None


def test_raw_records(spark, hourly):
    got = raw.build_raw(hourly, "city")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == TABLES["raw"].schema.split(", ")
    assert got.select("ingestion_id").distinct().count() == 192
    assert got.filter("api_response_time = 0.0 AND source = 'openweathermap'").count() == 192


def test_daily_and_kpis(hourly):
    daily = {r["city"]: r for r in gold.daily_summary(hourly).collect()}
    assert set(daily) == set(CITIES)
    london = daily["London"]
    assert london["record_count"] == 24 and london["most_common_weather"] == "Clear" and london["temp_category"] == "Mild"
    assert london["avg_temperature"] == pytest.approx(15 + sum(h % 5 for h in range(24)) / 24)
    kpis = reports.global_kpis(reports.key_kpis(hourly)).first()
    assert (kpis["total_cities"], kpis["total_records"], kpis["hottest_city"], kpis["coldest_city"]) == (8, 192, "Dubai", "London")


def test_mode_takes_the_smallest_of_equal_categories(spark):
    df = spark.createDataFrame([("k", c) for c in ["b", "a", "b", "a", None, None, None]], "k string, c string")
    got = summarise(df, ["k"], count="n", modes={"m": "c"})
    assert rows(got) == [("k", 7, "a")]


EXTREME = [
    ("Dubai", 42.0, 30, 5.0, "Clear"),
    ("Mumbai", 38.0, 85, 10.0, "Rain"),
    ("New York", 35.5, 60, 55.0, "Thunderstorm"),
    ("Oslo", 20.0, 60, 55.0, "Clear"),
    ("Bergen", 20.0, 90, 5.0, "Rain"),
    ("Nome", -20.0, 40, 5.0, "Snow"),
    ("Rome", 20.0, 40, 5.0, "Thunderstorm"),
    ("Pisa", 20.0, 40, 5.0, "Clear"),
]


@pytest.fixture()
def extreme(spark):
    df = spark.createDataFrame(EXTREME, "city string, temperature_celsius double, humidity int, wind_speed double, weather_main string")
    return df.withColumns(
        {
            "observation_time": F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"),
            "weather_description": F.lit("x"),
            "pressure": F.lit(1000),
        }
    )


def test_event_rules(extreme):
    detected = dict(rows(gold.detected_events(extreme), "city", "event_type"))
    assert detected == {
        "Dubai": "Heatwave", "Mumbai": "Heatwave", "New York": "Heatwave",
        "Oslo": "Storm", "Rome": "Storm", "Bergen": "Heavy Rain",
    }
    reported = dict(rows(reports.event_report(extreme, 7, NOW), "city", "event_type"))
    assert reported == {
        "Dubai": "Heatwave", "Mumbai": "Heatwave", "New York": "Heatwave",
        "Oslo": "Storm", "Bergen": "Heavy Rain", "Nome": "Freezing",
    }
    listed = dict(rows(gold.listed_events(extreme, 7, NOW), "city", "event_type"))
    assert "Rome" not in listed and "Nome" not in listed and listed["Oslo"] == "Storm"


def test_health(hourly):
    assert {r["data_health_status"] for r in reports.data_health(hourly, 7, NOW).collect()} == {"Incomplete"}
    assert {r["data_health_status"] for r in reports.data_health(hourly, 7, "2024-01-02 05:00:00").collect()} == {"Stale"}
    complete = health.completeness_score(health.completeness(hourly, 7, NOW))
    assert {tuple(r) for r in complete.select("days_analyzed", "complete_days", "quality_score").collect()} == {(1, 1, 100.0)}
    scored = silver_plans.score(hourly)
    summary = health.check_summary(health.all_checks(scored, NOW)).first()
    assert summary["total_checks"] == 24 and summary["critical_alerts"] == 0
    assert rows(metrics.quality_alert(health.check_summary(health.all_checks(scored, NOW))), "severity") == [("info",)]


def test_coverage_with_expected_keys(spark, hourly):
    expected = spark.createDataFrame([(c,) for c in [*CITIES, "Oslo"]], "city string")
    assert rows(health.poor_coverage(hourly, 24, NOW, expected), "city", "coverage_status") == [("Oslo", "No Data")]
    assert health.poor_coverage(hourly, 24, NOW).count() == 0


def test_metrics(spark, hourly):
    scored = silver_plans.score(hourly)
    points = metrics.weather_metrics(scored, 24, NOW).unionByName(metrics.quality_metrics(scored, 24, NOW))
    values = dict(rows(points, "name", "value"))
    assert values["quality.total_records"] == 192 and values["weather.global_max_temp"] == 26.0
    summary = metrics.metric_summary(points)
    assert rows(summary.filter("name = 'quality.valid_ratio'"), "current", "count", "unit") == [(100.0, 1, "percent")]
    with pytest.raises(ValueError):
        storage.export_metrics(points, scratch_path(spark, "x"), "xml")
    assert storage.flat_tags(points, ["period"]).columns == ["name", "value", "timestamp", "unit", "period"]


def test_marts(hourly):
    staged = silver_plans.staging(silver_plans.score(hourly))
    by_reading, by_day = marts.key_mart(staged), marts.key_mart(staged, "day")
    assert (by_reading.count(), by_day.count()) == (192, 8)
    assert rows(by_day.filter("city = 'Dubai'"), "temp_rank_global", "temp_rank_daily", "temp_percentile") == [(1, 1, 1.0)]
    line = marts.global_mart(staged).first()
    assert (line["active_cities"], line["hottest_city"], line["coldest_city"]) == (8, "Dubai", "London")
    assert line["weather_distribution"].startswith('[{"weather":"Clear","count":48,"percentage":25.0}')


def test_episodes(spark):
    kinds = [40.0, 41.0, 20.0, 40.0, 20.0]
    df = spark.createDataFrame(
        [("k", datetime(2024, 1, 1, h), t, 1.0, "Clear") for h, t in enumerate(kinds)],
        "city string, observation_time timestamp_ntz, temperature_celsius double, wind_speed double, weather_main string",
    )
    assert rows(declared.event_episodes(df), "readings", "event_duration_minutes") == [(1, 0), (2, 60)]


def test_past_and_future(hourly):
    past, future = split_at(hourly, "2024-01-01 11:00:00")
    assert (past.count(), future.count()) == (96, 96)


# ---------------------------------------------------------------- storage


def frame(spark, data):
    return spark.createDataFrame(data, "city string, observation_time int, v int")


def test_upsert_is_idempotent_and_prunes(spark):
    path = scratch_path(spark, "t")
    keys = ["city", "observation_time"]
    storage.upsert(frame(spark, [("a", 1, 1), ("a", 2, 2), ("b", 1, 3)]), path, keys, ["city"])
    change = frame(spark, [("a", 2, 20), ("a", 3, 30), (None, 1, 9)])
    for _ in range(2):
        storage.upsert(change.filter("city IS NOT NULL"), path, keys, ["city"])
    assert rows(spark.read.parquet(path), *keys, "v") == [("a", 1, 1), ("a", 2, 20), ("a", 3, 30), ("b", 1, 3)]
    with pytest.raises(ValueError):
        storage.upsert(frame(spark, [("a", 1, 1), ("a", 1, 2)]), path, keys, ["city"])
    with pytest.raises(ValueError):
        storage.upsert(change, path, ["observation_time"], ["city"])


def test_null_keys_replace_nothing_and_replay_once(spark):
    path = scratch_path(spark, "t")
    keys = ["city", "observation_time"]
    for _ in range(3):
        storage.upsert(frame(spark, [(None, 1, 1), (None, 1, 2), (None, 1, 2), ("a", 1, 2)]), path, keys)
    assert rows(spark.read.parquet(path)) == sorted([(None, 1, 1), (None, 1, 2), ("a", 1, 2)], key=repr)


def test_an_emptied_folder_is_no_new_table(spark):
    path = scratch_path(spark, "t")
    storage.upsert(frame(spark, [("a", 1, 1)]), path, ["city", "observation_time"])
    for f in spark.read.parquet(path).inputFiles():
        storage.delete(spark, f)
    with pytest.raises(AnalysisException):
        storage.upsert(frame(spark, [("b", 1, 1)]), path, ["city", "observation_time"])


def test_upsert_by_a_derived_day_reads_touched_days_only(spark):
    path = scratch_path(spark, "t")
    day = {"day": F.date_add(F.lit("2024-01-01").cast("date"), F.col("observation_time"))}
    keys = ["city", "observation_time"]
    storage.upsert(frame(spark, [("a", t, t) for t in range(30)]), path, keys, ["day"], derived=day)
    storage.upsert(frame(spark, [("a", 3, 33), ("a", 4, 44), ("b", 4, 1)]), path, keys, ["day"], derived=day)
    want = [("a", t, {3: 33, 4: 44}.get(t, t)) for t in range(30)] + [("b", 4, 1)]
    assert rows(spark.read.parquet(path), *keys, "v") == sorted(want, key=repr)
    source = frame(spark, [("a", 3, 33), ("a", 4, 44)]).withColumns(day)
    plan = storage._touched(spark.read.parquet(path), source, ["day"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-04" in plan and "2024-01-05" in plan


def test_retention_drops_folders(spark):
    path = scratch_path(spark, "t")
    df = payloads(spark).select("ingestion_id", "ingestion_time").withColumn("day", F.to_date("ingestion_time"))
    storage.append(df, path, ["day"])
    before = set(spark.read.parquet(path).inputFiles())
    storage.apply_retention(spark, path, "ingestion_time", 30, NOW, ["day"])
    after = set(spark.read.parquet(path).inputFiles())
    assert rows(spark.read.parquet(path), "ingestion_id") == [("1",), ("2",), ("3",), ("4",)]
    assert before & after  # folders that keep all rows aren't written again


def test_profile_counts_bytes(spark):
    import os

    path = scratch_path(spark, "t")
    storage.append(frame(spark, [("a", i, i) for i in range(100)]).repartition(3), path)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    got = storage.dataset_profile(spark.read.parquet(path)).first()
    assert tuple(got) == (sum(os.path.getsize(f"{path}/{f}") for f in files), len(files), 100)


def test_router(spark):
    path = scratch_path(spark, "t")
    assert storage.write_gold(frame(spark, []), path) == "skipped"
    assert storage.write_gold(frame(spark, [("a", 1, 1)]), path) == "upserted on city, observation_time"
    assert storage.write_gold(frame(spark, [("a", 1, 1)]).drop("observation_time"), scratch_path(spark, "u")) == "appended"
    daily = frame(spark, [("a", 1, 1)]).withColumn("observation_date", F.lit("2024-01-01").cast("date"))
    assert storage.write_gold(daily, scratch_path(spark, "d")) == "upserted on city, observation_date"


def test_tables_and_retention(spark):
    for name, layout in TABLES.items():
        path = scratch_path(spark, name)
        made = storage.create_table(spark, name, path)
        assert made.count() == 0 and set(layout.partition_by) <= set(made.columns)
    path = scratch_path(spark, "raw")
    df = payloads(spark)
    storage.append(df, path, ["source", "source_city"])
    storage.apply_retention(spark, path, "ingestion_time", 30, NOW, ["source", "source_city"])
    assert rows(spark.read.parquet(path), "ingestion_id") == [("1",), ("2",), ("3",), ("4",)]


def test_bound_parameters_are_not_spliced(spark):
    df = frame(spark, [("O'Hare", 1, 1), ("x", 1, 2)])
    got = storage.query(spark, "SELECT v FROM gf_t WHERE city = :city", {"gf_t": df}, city="O'Hare")
    assert rows(got) == [(1,)]
    assert storage.query(spark, "SELECT v FROM gf_t WHERE city = :city", {"gf_t": df}, city="x' OR '1'='1").count() == 0


def test_stream_equals_batch_and_late_loads(spark):
    from gaugeflow.streaming import pipelines

    folder, path, state = (scratch_path(spark, n) for n in ("in", "silver", "state"))
    whole = payloads(spark).filter("ingestion_id <> '4'")
    whole.filter("ingestion_id = '2'").write.parquet(folder)
    for batch in ("ingestion_id <> '2'", "ingestion_id = '2'"):
        stream = spark.readStream.schema(whole.schema).parquet(folder)
        pipelines.raw_to_silver(stream, path, state).awaitTermination()
        whole.filter(batch).write.mode("append").parquet(folder)
    pipelines.raw_to_silver(spark.readStream.schema(whole.schema).parquet(folder), path, state).awaitTermination()
    names = ["city", "observation_time", "temperature_celsius", "ingestion_id"]
    assert rows(spark.read.parquet(path), *names) == rows(silver_plans.clean(whole), *names)
