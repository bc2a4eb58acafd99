"""Marts and frames kept up to date by changes against full rebuilds."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gaugeflow.plans import gold, incremental, marts
from gaugeflow.runtime import scratch_path
from gaugeflow.sources import staging
from gaugeflow.spec import ROLES

SCHEMA = (
    "city string, observation_time timestamp_ntz, temperature_celsius double, humidity int, wind_speed double, "
    "weather_main string, ingestion_time int, ingestion_id string, is_valid boolean"
)
START = datetime(2024, 1, 1)
NAMES = ["city", "observation_date", "hourly_readings", "avg_temp", "avg_humidity", "avg_wind_speed", "max_temp", "min_temp", "most_common_weather"]


def readings(n, seed, days=20, cities="abc"):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        t = START + timedelta(hours=rng.randrange(24 * days))
        out.append(
            (rng.choice(cities), t, rng.choice([None, 1.5, 2.0, 7.25, -3.0]), rng.choice([None, 40, 50]), 0.5 * rng.randrange(9),
             rng.choice(["Rain", "Clear", None]), i, str(i), rng.random() < 0.85)
        )
    return out


def final(spark, data):
    """The newest reading of each key and time, that counts."""
    df = spark.createDataFrame(data, SCHEMA)
    return gold.latest_per(df, ["city", "observation_time"], "ingestion_time", "ingestion_id").filter("is_valid")


def test_signed_states_cancel(spark):
    data = readings(60, 3)
    df = spark.createDataFrame(data, SCHEMA).withColumn("observation_date", F.to_date("observation_time"))
    signed = df.withColumn("_sign", F.lit(1)).unionByName(df.filter("ingestion_time % 2 = 0").withColumn("_sign", F.lit(-1)))
    kept = incremental.states(df.filter("ingestion_time % 2 = 1").withColumn("_sign", F.lit(1)))
    assert rows(incremental.states(signed).filter("n > 0"), *kept.columns) == rows(kept)


def test_loads_and_corrections_equal_the_full_rebuild(spark):
    data = readings(200, 1, days=6)
    paths = [scratch_path(spark, n) for n in ("silver", "state")]
    rng = random.Random(1)
    order = list(range(len(data)))
    rng.shuffle(order)  # older loads arrive after newer ones
    for part in (order[:120], order[120:], order[100:150]):
        incremental.load(spark.createDataFrame([data[i] for i in part], SCHEMA), *paths)
    state = staging.read(spark, paths[1])
    whole = final(spark, data).withColumn("observation_date", F.to_date("observation_time")).withColumn("_sign", F.lit(1))
    assert rows(state.drop("_load"), *incremental.states(whole).columns) == rows(incremental.states(whole))
    got, want = rows(incremental.daily(state), *NAMES), rows(marts.daily_stats(whole), *NAMES)
    assert [r[:3] + r[6:] for r in got] == [r[:3] + r[6:] for r in want]
    assert all(a[i] == pytest.approx(b[i]) for a, b in zip(got, want, strict=True) for i in (3, 4, 5))


def test_a_correction_touches_its_day_only(spark):
    paths = [scratch_path(spark, n) for n in ("silver", "state")]
    data = readings(200, 5, days=5)
    incremental.load(spark.createDataFrame(data, SCHEMA), *paths)
    files = lambda: {(r["observation_date"], r["f"]) for r in staging.read(spark, paths[1]).select("observation_date", F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before = files()
    top = max((r for r in data if r[8] and r[2] is not None), key=lambda r: r[2])
    fix = (*top[:2], -50.0, *top[3:6], 9999, "fix", True)  # the extreme goes
    incremental.load(spark.createDataFrame([fix], SCHEMA), *paths)
    assert {d for d, _ in before ^ files()} == {top[1].date()}
    whole = final(spark, [*data, fix]).withColumn("observation_date", F.to_date("observation_time")).withColumn("_sign", F.lit(1))
    assert rows(staging.read(spark, paths[1]).drop("_load"), *incremental.states(whole).columns) == rows(incremental.states(whole))


@pytest.mark.parametrize("step", ["upsert", "delete"])
def test_a_load_that_dies_is_finished_once(spark, step, monkeypatch):
    paths = [scratch_path(spark, n) for n in ("silver", "state")]
    data = readings(120, 8, days=4)
    incremental.load(spark.createDataFrame(data[:80], SCHEMA), *paths)
    real, calls = getattr(incremental, step), []

    def dies(*args, **kwargs):
        calls.append(args)
        if step == "delete" and len(calls) < 2:  # the first one clears the way for the draft
            return real(*args, **kwargs)
        raise KeyboardInterrupt

    monkeypatch.setattr(incremental, step, dies)
    with pytest.raises(KeyboardInterrupt):
        incremental.load(spark.createDataFrame(data[80:], SCHEMA), *paths)
    monkeypatch.setattr(incremental, step, real)
    incremental.load(spark.createDataFrame(data[80:], SCHEMA), *paths)
    whole = final(spark, data).withColumn("observation_date", F.to_date("observation_time")).withColumn("_sign", F.lit(1))
    assert rows(staging.read(spark, paths[1]).drop("_load"), *incremental.states(whole).columns) == rows(incremental.states(whole))


FRAMES = [("range", 7 * 86_400), ("rows", 1)]


def trends(df):
    return gold.trends(df, F.lit(0)).drop("last_updated")


@pytest.mark.parametrize(("compute", "frames"), [(trends, FRAMES), (gold.full_moving_averages, [("rows", 168)])])
def test_frames_equal_the_full_run(spark, compute, frames):
    data = readings(900, 4, days=24, cities="ab")
    silver, state, out = (scratch_path(spark, n) for n in ("silver", "state", "trend"))
    order = sorted(range(len(data)), key=lambda i: (i >= 850, data[i][1]))
    for part in (order[:850], order[850:]):  # the last ones are late
        incremental.load(spark.createDataFrame([data[i] for i in part], SCHEMA), silver, state, results={out: (compute, frames)})
    want = compute(final(spark, data))
    assert rows(staging.read(spark, out), *want.columns) == rows(want)


def test_a_late_reading_reads_and_writes_the_days_it_reaches(spark):
    data = [("a", START + timedelta(hours=12 * i), 1.0 * i, 50, 1.0, "Rain", 0, str(i), True) for i in range(120)]
    silver, state, out = (scratch_path(spark, n) for n in ("silver", "state", "trend"))
    results = {out: (trends, FRAMES)}
    incremental.load(spark.createDataFrame(data, SCHEMA), silver, state, results=results)
    files = lambda: {r["f"]: r["observation_date"] for r in staging.read(spark, out).select("observation_date", F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before = files()
    late = ("a", START + timedelta(days=20, hours=5), 99.0, 50, 1.0, "Rain", 1, "late", True)
    incremental.load(spark.createDataFrame([late], SCHEMA), silver, state, results=results)
    written = {(d - START.date()).days for f, d in files().items() if f not in before}
    assert written == set(range(20, 28))
    days = spark.createDataFrame([("a", START.date() + timedelta(days=i), 2) for i in range(60)], "city string, observation_date date, n bigint")
    changed = days.filter("observation_date = '2024-01-21'")
    got = {(r["observation_date"] - START.date()).days: r["affected"] for r in incremental.reach(days, changed, FRAMES, ROLES).collect()}
    assert sorted(got) == list(range(13, 28)) and sorted(d for d, a in got.items() if a) == list(range(20, 28))
    assert rows(staging.read(spark, out), *trends(final(spark, data)).columns) == rows(trends(final(spark, [*data, late])))
