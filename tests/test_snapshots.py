"""The history kept over loads against one recomputation."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gaugeflow.plans.declared import history
from gaugeflow.runtime import scratch_path
from gaugeflow.sources import snapshots

SCHEMA = "k string, at timestamp_ntz, state string"
START = datetime(2024, 1, 1)


def versions(n, seed):
    rng = random.Random(seed)
    at = lambda: None if rng.random() < 0.02 else START + timedelta(hours=rng.randrange(24 * 12))
    return [(rng.choice(["a", "b", "c", "", None]), at(), rng.choice(["x", "y", None])) for _ in range(n)]


def kept(spark, path, log):
    return rows(snapshots.read(spark, path, log, "at"), "k", "at", "state", "valid_from", "valid_to")


@pytest.mark.parametrize(("seed", "grain"), [(1, "day"), (2, "month")])
def test_loads_in_any_split_equal_one_recomputation(spark, seed, grain):
    data = versions(120, seed)
    log = spark.createDataFrame(data, SCHEMA)
    want = rows(history(log, ["k"], "at"), "k", "at", "state", "valid_from", "valid_to")
    for split in ([0, 40, 80, 120],) if grain == "month" else ([0, 100, 101, 120],):
        path = scratch_path(spark, "history")
        cuts = list(zip(split, split[1:], strict=False))
        for a, b in [*cuts, cuts[0]]:  # the first load comes again
            snapshots.keep_history(spark.createDataFrame(data[a:b], SCHEMA), path, ["k"], "at", grain)
        assert kept(spark, path, log) == want
        assert snapshots.read(spark, path, log, "at").where("closed_on IS NULL").count() == len({r[0] for r in data})


def files(spark, path, log, where):
    found = snapshots.read(spark, path, log, "at").where(where)
    return {r[0] for r in found.select("_metadata.file_path").distinct().collect()}


def test_closed_days_are_not_written_again(spark):
    path = scratch_path(spark, "history")
    day = lambda d, k, s: (k, START + timedelta(days=d), s)
    log = spark.createDataFrame([day(d, k, "x") for d in range(10) for k in "ab"], SCHEMA)
    snapshots.keep_history(log, path, ["k"], "at")
    before = files(spark, path, log, "closed_on IS NOT NULL")
    snapshots.keep_history(spark.createDataFrame([day(10, "a", "y"), day(11, "c", "x")], SCHEMA), path, ["k"], "at")
    after = files(spark, path, log, "closed_on IS NOT NULL")
    assert before < after and len(after - before) == 1
    # a late version cuts one span: its own day is added, the day the span ended is written again
    snapshots.keep_history(spark.createDataFrame([("a", START + timedelta(days=4, hours=5), "late")], SCHEMA), path, ["k"], "at")
    assert len(after - files(spark, path, log, "closed_on IS NOT NULL")) <= len(files(spark, path, log, "closed_on >= '2024-01-05'"))
    assert files(spark, path, log, "closed_on < '2024-01-05'") <= after
    got = snapshots.read(spark, path, log, "at").where("k = 'a' AND state = 'late'").first()
    assert got["valid_to"] == START + timedelta(days=5) and kept(spark, path, log) == rows(
        history(snapshots.read(spark, path, log, "at").select("k", "at", "state"), ["k"], "at"), "k", "at", "state", "valid_from", "valid_to"
    )


def test_an_empty_load_changes_nothing(spark):
    path = scratch_path(spark, "history")
    log = spark.createDataFrame(versions(20, 3), SCHEMA)
    for load in (log, log.where(F.lit(False))):
        snapshots.keep_history(load, path, ["k"], "at")
    assert kept(spark, path, log) == rows(history(log, ["k"], "at"), "k", "at", "state", "valid_from", "valid_to")
