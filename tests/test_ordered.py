"""Order-dependent operators on a skewed table, against plain Python, with and without splitting."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gaugeflow.operators import ordered

KEYS = ["k"]


def make():
    """One key holds most rows; values repeat; a key is NULL."""
    rnd = random.Random(7)
    out, t = [], datetime(2024, 1, 1)
    sizes = {"hot": 220, "warm": 40, "cold": 3, None: 30}
    for key, n in sizes.items():
        at = t
        for _ in range(n):
            at += timedelta(minutes=rnd.choice([1, 1, 5, 60, 700]))
            out.append((key, at, float(rnd.randint(-4, 4)) if rnd.random() > 0.05 else None))
    rnd.shuffle(out)
    return [(i, *r) for i, r in enumerate(out)]


DATA = make()


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(DATA, "id bigint, k string, t timestamp_ntz, v double").repartition(5)


@pytest.fixture(params=["plain", "split"])
def mode(request):
    if request.param == "split":
        request.getfixturevalue("tiny_groups")
    return request.param


def groups():
    out = {}
    for r in sorted(DATA, key=lambda r: r[2]):
        out.setdefault(r[1], []).append(r)
    return out


def test_row_numbers(table, mode):
    want = sorted((r[0], i + 1) for g in groups().values() for i, r in enumerate(g))
    assert rows(ordered.row_numbers(table, KEYS, ["t"], "n"), "id", "n") == sorted(want, key=repr)


@pytest.mark.parametrize("ahead", [False, True])
def test_neighbour(table, mode, ahead):
    want = []
    for g in groups().values():
        g = g[::-1] if ahead else g
        want += [(r[0], p[0] if p else None, p[3] if p else None) for r, p in zip(g, [None, *g])]
    got = ordered.neighbour(table, KEYS, ["t"], {"pid": "id", "pv": "v"}, ahead=ahead)
    assert rows(got, "id", "pid", "pv") == sorted(want, key=repr)


def test_running(table, mode):
    want = []
    for g in groups().values():
        for i, r in enumerate(g):
            seen = [x[3] for x in g[: i + 1] if x[3] is not None]
            want.append((r[0], sum(seen) if seen else None, len(seen), min(seen, default=None), max(seen, default=None)))
    parts = {f"r_{k}": (k, F.col("v")) for k in ("sum", "count", "min", "max")}
    got = ordered.running(table, KEYS, ["t"], parts)
    assert rows(got, "id", *parts) == sorted(want, key=repr)


def _frame(values):
    seen = [x for x in values if x is not None]
    if not seen:
        return (None, None, 0, None, None)
    return (round(sum(seen) / len(seen), 9), sum(seen), len(seen), min(seen), max(seen))


FNS = ("avg", "sum", "count", "min", "max")


@pytest.mark.parametrize("n", [1, 7, 60])
def test_rolling_rows(table, mode, n):
    want = [
        (r[0], *_frame([x[3] for x in g[max(0, i - n + 1) : i + 1]]))
        for g in groups().values()
        for i, r in enumerate(g)
    ]
    got = ordered.rolling_rows(table, KEYS, ["t"], {f"f_{f}": (f, "v", n) for f in FNS})
    got = got.withColumn("f_avg", F.round("f_avg", 9))
    assert rows(got, "id", *[f"f_{f}" for f in FNS]) == sorted(want, key=repr)


@pytest.mark.parametrize("maximal", ["native", "cells", "runs"])
@pytest.mark.parametrize("seconds", [3600, 86400, 5 * 86400])
def test_rolling_range(spark, table, maximal, seconds):
    settings = {
        "native": {},
        "cells": {"spark.gaugeflow.maxFrameRows": "1"},
        "runs": {"spark.gaugeflow.maxFrameRows": "1", "spark.gaugeflow.maxGroupRows": "4"},
    }[maximal]
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = ordered.rolling_range(table, KEYS, "t", {f"f_{f}": (f, "v", seconds) for f in FNS})
        got = got.withColumn("f_avg", F.round("f_avg", 9))
        mine = rows(got, "id", *[f"f_{f}" for f in FNS])
    finally:
        for k in settings:
            spark.conf.unset(k)
    want = []
    for g in groups().values():
        for r in g:
            inside = [x[3] for x in g if r[2] - timedelta(seconds=seconds) <= x[2] <= r[2]]
            want.append((r[0], *_frame(inside)))
    assert mine == sorted(want, key=repr)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_ranks_of_odd_values_go_on_over_runs(spark, tiny_groups, keys, descending):
    """One value over many runs, NULL, NaN and both zeros: the same as one window gives."""
    odd = [None, float("nan"), 0.0, -0.0, 1.0, float("-inf")]
    data = [(i, [None, "a", "b"][i % 3], 2.0 if i % 4 else odd[i // 4 % 6]) for i in range(600)]
    df = spark.createDataFrame(data, "id bigint, k string, v double").repartition(4)
    split = ordered.ranks(df, keys, "v", rank="a", percent_rank="b", descending=descending)
    plain = ordered.ranks(df, keys, "v", rank="a", percent_rank="b", descending=descending, size=ordered.SMALL)
    assert rows(split, "id", "a", "b") == rows(plain, "id", "a", "b")


def test_runs_hand_on_two_rows_each(spark, tiny_groups):
    df = spark.range(1000).withColumn("v", F.col("id") % 400)
    pinned = ordered.pin_runs(df, [], ["v"], 1000)
    ends = ordered._edges(pinned.withColumn("_rank", F.lit(1)), ["v"], "_rank")
    assert ends.count() == 2 * pinned.select(ordered.RUN).distinct().count()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_ranks_with_ties(table, mode, keys, descending):
    present = table.filter("v IS NOT NULL")
    want = []
    for r in DATA:
        if r[3] is None:
            continue
        peers = [x[3] for x in DATA if x[3] is not None and (not keys or x[1] == r[1])]
        before = sum(x > r[3] if descending else x < r[3] for x in peers)
        share = before / (len(peers) - 1) if len(peers) > 1 else 0.0
        want.append((r[0], before + 1, round(share, 9)))
    got = ordered.ranks(present, keys, "v", rank="a", percent_rank="b", descending=descending)
    assert rows(got.withColumn("b", F.round("b", 9)), "id", "a", "b") == sorted(want, key=repr)


def test_quantiles(table, mode):
    import numpy as np

    points = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    want = []
    for key, g in groups().items():
        values = [r[3] for r in g if r[3] is not None]
        want.append((key, *[round(float(np.quantile(values, p)), 9) + 0.0 for p in points.values()]))
    got = ordered.quantiles(table, KEYS, "v", points)
    got = got.select("k", *[(F.round(c, 9) + 0.0).alias(c) for c in points])
    assert rows(got) == sorted(want, key=repr)


def test_a_carried_table_has_at_most_a_row_per_run(spark, table, tiny_groups):
    pinned = ordered.pin_runs(table, KEYS, ["t"], len(DATA))
    per_run = pinned.groupBy("_run").agg(F.min("t"), F.countDistinct(F.coalesce("k", F.lit("-"))).alias("n"))
    assert per_run.count() > 5
    keys_of = pinned.select("_run", "k").distinct()
    first = keys_of.groupBy("k").agg(F.min("_run").alias("f"))
    going_on = keys_of.alias("a").join(first.alias("b"), F.expr("a.k <=> b.k")).filter("a._run > b.f")
    assert going_on.groupBy("_run").count().filter("count > 1").count() == 0
    # no run holds more than a small multiple of the limit
    assert pinned.groupBy("_run").count().agg(F.max("count")).first()[0] <= 75


def test_copies_are_reduced_before_the_shuffle(table):
    from gaugeflow.operators.grouping import latest_per

    plan = latest_per(table, ["k"], "t", "id")._jdf.queryExecution().executedPlan().toString()
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    order = [i for i, line in enumerate(lines) if line.startswith(("Exchange hash", "WindowGroupLimit"))]
    assert "Final" in lines[order[0]] and lines[order[1]].startswith("Exchange") and "Partial" in lines[order[2]]
    want = sorted(((k, max(g, key=lambda r: (r[2], r[0]))[0]) for k, g in groups().items()), key=repr)
    assert rows(latest_per(table, ["k"], "t", "id"), "k", "id") == want


ODD = [("a", 1, "2024-01-01 00:00:00"), ("a", 1, "2024-01-01 00:00:00"), ("a", 2, None), ("a", 3, None), (None, 4, None), (None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    """Equal rows, rows without a time or a key, and decimals."""
    more = [("a", i % 7, f"2024-01-0{1 + i % 9} 0{i % 8}:00:00") for i in range(60)] + [(None, i, f"2024-03-31 0{i}:30:00") for i in range(8)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ODD + more)], "id int, k string, v int, at string")
    return df.select("id", "k", F.col("v").cast("decimal(10,2)").alias("v"), F.col("at").cast("timestamp_ntz").alias("t"))


PLANS = {
    "rolling_range": lambda df: ordered.rolling_range(
        df, KEYS, "t", {f"{f}_{s}": (f, "v", s) for f in ("avg", "sum", "count", "min", "max") for s in (3600, 7200)}
    ),
    "rolling_rows": lambda df: ordered.rolling_rows(df, KEYS, ["t"], {"s": ("avg", "v", 3)}),
    "neighbour": lambda df: ordered.neighbour(df, KEYS, ["t"], {"p": "id", "q": "v"}),
    "neighbour_ahead": lambda df: ordered.neighbour(df, KEYS, ["t"], {"p": "id"}, ahead=True),
    "row_numbers": lambda df: ordered.row_numbers(df, KEYS, ["t"], "n"),
    "ranks": lambda df: ordered.ranks(df, KEYS, "v", rank="r", percent_rank="p"),
    "ranks_of_all": lambda df: ordered.ranks(df, [], "v", rank="r", percent_rank="p", descending=True),
    "quantiles": lambda df: ordered.quantiles(df, KEYS, "v", {"q": 0.3, "m": 0.5}),
    "quantiles_of_all": lambda df: ordered.quantiles(df, [], "v", {"q": 0.3, "m": 0.5}),
    "running": lambda df: ordered.running(df, KEYS, ["t"], {"s": ("sum", F.col("v")), "n": ("count", F.col("v"))}),
}


@pytest.mark.parametrize("name", list(PLANS))
def test_limits_change_neither_rows_nor_types(spark, odd, name):
    plain = PLANS[name](odd)
    want, kinds = rows(plain), plain.dtypes
    for conf in ({"maxGroupRows": "4", "maxFrameRows": "1"}, {"maxFrameRows": "1"}, {"maxGroupRows": "4"}):
        for k, v in conf.items():
            spark.conf.set(f"spark.gaugeflow.{k}", v)
        try:
            split = PLANS[name](odd)
            assert split.dtypes == kinds, conf
            got = rows(split)
        finally:
            for k in conf:
                spark.conf.unset(f"spark.gaugeflow.{k}")
        near = lambda v: round(float(v), 6) if isinstance(v, float) or hasattr(v, "quantize") else v
        assert sorted([tuple(map(near, r)) for r in got], key=repr) == sorted([tuple(map(near, r)) for r in want], key=repr), conf
