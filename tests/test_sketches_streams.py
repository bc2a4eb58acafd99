"""Sketches over look-backs, checks in the write, and streams of several micro-batches."""

import random
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from gaugeflow.operators import checks
from gaugeflow.plans import declared, sketches
from gaugeflow.runtime import scratch_path
from gaugeflow.sources import staging, storage
from gaugeflow.streaming import pipelines

START = datetime(2024, 1, 1)


def test_quantiles_and_distinct_counts_stay_within_their_errors(spark):
    rng = random.Random(6)
    data = [("hot" if i % 3 else f"c{i % 5}", START + timedelta(minutes=rng.randrange(30 * 1440)), rng.gauss(0, 1) ** 3, rng.randrange(20_000)) for i in range(60_000)]
    df = spark.createDataFrame(data, "city string, observation_time timestamp_ntz, temperature_celsius double, sensor int")
    path = scratch_path(spark, "sketches")
    for part in ("observation_time < '2024-01-20'", "observation_time >= '2024-01-20'", "observation_time >= '2024-01-30'"):
        sketches.store(df.filter(part), path, ["temperature_celsius"], ["sensor"])
    wanted = {f"q{p}": ("temperature_celsius", p / 100) for p in (1, 25, 50, 90, 99)}
    for days in (7, 90):
        got = sketches.look_back(staging.read(spark, path), days, START + timedelta(days=30), ["city"], wanted, {"sensors": "sensor"}).collect()
        since = START + timedelta(days=30 - days)
        assert len(got) == 6
        for r in got:
            mine = [d for d in data if d[0] == r["city"] and d[1] >= since]
            assert r["readings"] == len(mine)
            for name, (_, p) in wanted.items():
                below, upto = sum(d[2] < r[name] for d in mine) / len(mine), sum(d[2] <= r[name] for d in mine) / len(mine)
                assert below - 2 * sketches.RANK_ERROR <= p <= upto + 2 * sketches.RANK_ERROR
            exact = len({d[3] for d in mine})
            assert abs(r["sensors"] - exact) <= 5 * sketches.DISTINCT_ERROR * exact + 1


def test_values_that_are_missing_give_null(spark):
    df = spark.createDataFrame([("a", START, None), ("b", START, 2.0)], "city string, observation_time timestamp_ntz, temperature_celsius double")
    got = sketches.look_back(sketches.daily_sketches(df, ["temperature_celsius"]), 1, START, ["city"], {"m": ("temperature_celsius", 0.5)})
    assert rows(got) == [("a", 1, None), ("b", 1, 2.0)]


def test_checks_are_counted_in_the_write(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i) for i in range(100)], "id int, v int")
    watched = checks.Watched(df, {"small": F.col("v") < 50, "there": F.col("v").isNotNull()})
    storage.append(watched.rows, scratch_path(spark, "t"))
    assert rows(watched.result()) == rows(checks.run_row_checks(df, {"small": F.col("v") < 50, "there": F.col("v").isNotNull()}))
    assert watched.rows_written == 100


SCHEMA = "city string, observation_time timestamp_ntz, temperature_celsius double, wind_speed double, weather_main string"


def stream(spark, batches, schema):
    path = scratch_path(spark, "in")
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_readings_merge_two_sessions(spark):
    """Hourly readings in several batches equal the episodes of consecutive readings of the whole table."""
    hour = lambda h: START + timedelta(hours=h)
    rng = random.Random(2)
    data = [(c, hour(h), 36.0 if (h // 5) % 2 else 20.0, 1.0, "Clear") for c in "ab" for h in range(120)]
    last = [("a", hour(400), 20.0, 1.0, "Clear")]  # moves the watermark past all episodes
    late = set(rng.sample(range(len(data)), 60))
    order = sorted(range(len(data)), key=lambda i: (data[i][1] + timedelta(hours=20 if i in late else 0)))
    batches = [[data[i] for i in order[a : a + 48]] for a in range(0, len(data), 48)] + [last, last]
    out = scratch_path(spark, "out")
    found = pipelines.event_sessions(stream(spark, batches, SCHEMA), "61 minutes", "48 hours")
    pipelines.append_to(found, out, scratch_path(spark, "state")).awaitTermination()
    whole = spark.createDataFrame(data, SCHEMA)
    names = ["city", "event_type", "readings", "started", "ended", "event_duration_minutes"]
    assert rows(spark.read.parquet(out), *names) == rows(declared.event_episodes(whole), *names)
    assert rows(pipelines.event_sessions(whole, "61 minutes"), *names) == rows(declared.event_episodes(whole), *names)


def test_forecasts_meet_readings_and_leave_the_state(spark):
    day = lambda d: (START + timedelta(days=d)).date()
    daily = [(c, day(d), 1.0 + d % 7) for c in "abc" for d in range(40)]
    schema = "city string, observation_date date, avg_temperature double"
    batches = [[r for r in daily if (r[1] - day(0)).days // 5 == b] for b in range(8)]
    whole = spark.createDataFrame(daily, schema)
    days, source = stream(spark, batches, schema), stream(spark, batches[:1] + batches[1:], schema)
    out = scratch_path(spark, "out")
    query = pipelines.append_to(pipelines.forecasts_met(declared.persistence_forecast(source), days, "6 days"), out, scratch_path(spark, "state"))
    query.awaitTermination()
    want = declared.forecast_accuracy(declared.persistence_forecast(whole), whole)
    assert rows(spark.read.parquet(out), *want.columns) == rows(want)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 3 * 2 * 25  # some days of both sides, not all 240 rows
