"""Clustering along a curve, and packing of small files."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gaugeflow.runtime import scratch_path
from gaugeflow.sources import layout, staging, storage


def grid(spark, n=20_000, keys=200):
    rng = random.Random(1)
    data = [(f"k{int(keys * rng.random() ** 2):03d}", rng.randrange(100_000), i) for i in range(n)]
    return spark.createDataFrame(data, "key string, at int, v int")


def read_for(df, column, value):
    """Files whose span holds a value."""
    return layout.spans(df, [column]).where(F.lit(value).between(F.col(f"min_{column}"), F.col(f"max_{column}"))).count()


def test_a_filter_on_either_column_skips_files(spark):
    path, target = scratch_path(spark, "t"), scratch_path(spark, "u")
    df = grid(spark)
    storage.append(df.repartitionByRange(64, "key", "at"), path)
    size = layout.files_of(spark, path).agg(F.sum("length")).first()[0]
    layout.cluster(spark, path, ["key", "at"], target=target, file_bytes=size // 64)
    sorted_, curved = spark.read.parquet(path), spark.read.parquet(target)
    assert rows(curved) == rows(df) and 50 <= layout.spans(curved, ["at"]).count() <= 66
    times = [read_for(curved, "at", t) for t in (1_000, 30_000, 77_777)]
    keys = [read_for(curved, "key", k) for k in ("k003", "k050", "k150")]
    assert max(times) <= 24 and max(keys) <= 24
    assert min(read_for(sorted_, "at", t) for t in (30_000, 77_777)) > 48  # a linear sort skips nothing by its second column


def test_clustering_in_place_by_three_columns_with_nulls_and_a_hot_key(spark):
    path = scratch_path(spark, "t")
    df = grid(spark, 6000).withColumns({"key": F.when(F.col("v") % 3 != 0, F.col("key")), "p": F.col("v") % 2, "m": F.create_map(F.lit("a"), F.col("v"))})
    storage.append(df, path, ["p"])
    layout.cluster(spark, path, ["p", "key", "at", "v"], ["p"], file_bytes=10_000)
    got = spark.read.parquet(path)
    assert rows(got.drop("m"), "key", "at", "v", "p") == rows(df.drop("m"), "key", "at", "v", "p")
    assert got.inputFiles() and got.where("m['a'] <> v").count() == 0
    sizes = [r["rows"] for r in layout.spans(got, ["v"]).collect()]
    assert len(sizes) > 4 and max(sizes) < 4 * 6000 / len(sizes)


@pytest.mark.parametrize("cuts", [[], [5], [1, 2, 3], list(range(0, 510, 2))])
def test_rank_is_the_number_of_smaller_cuts(spark, cuts):
    df = spark.createDataFrame([(v,) for v in (None, -1, 0, 1, 2, 3, 5, 100, 507, 508, 1000)], "v int")
    got = df.select("v", layout.rank(F.col("v"), cuts, df.schema["v"].dataType).alias("r")).collect()
    assert all(r["r"] == (0 if r["v"] is None else sum(c <= r["v"] for c in cuts)) for r in got)


def test_the_curve_interleaves_bits(spark):
    df = spark.range(16).select((F.col("id") % 4).alias("a"), F.floor(F.col("id") / 4).cast("bigint").alias("b"))
    got = df.select("a", "b", layout.curve([F.col("a"), F.col("b")], 2).alias("z")).collect()
    bit = lambda x, i: x >> i & 1
    assert all(r["z"] == bit(r["b"], 0) | bit(r["a"], 0) << 1 | bit(r["b"], 1) << 2 | bit(r["a"], 1) << 3 for r in got)


def files(spark, path):
    return {r["path"]: r["length"] for r in layout.files_of(spark, path).collect()}


@pytest.mark.parametrize("at_once", [1000, 4])
def test_packing_leaves_large_files_alone_and_ends(spark, at_once):
    path = scratch_path(spark, "odd [x]") + "/t %"
    df = grid(spark, 3000).withColumn("p", F.when(F.col("v") % 2 == 0, "New York").when(F.col("v") % 3 != 0, "a%b"))
    df.where("v < 2000").coalesce(1).write.partitionBy("p").parquet(path)
    large = files(spark, path)
    later = df.where("v >= 2000").withColumn("later", F.lit("x")).repartition(6)
    later.write.mode("append").partitionBy("p").parquet(path)
    target = 2 * min(large.values())
    gone = layout.pack(spark, path, ["p"], target, at_once=at_once)
    after = files(spark, path)
    assert gone >= 18 and large.items() <= after.items() and len(after) <= 8
    want = df.withColumn("later", F.when(F.col("v") >= 2000, "x"))
    assert rows(staging.read(spark, path), "key", "at", "v", "p", "later") == rows(want, "key", "at", "v", "p", "later")
    assert layout.pack(spark, path, ["p"], target, at_once=at_once) == 0 and files(spark, path) == after


def test_a_pack_that_dies_is_read_whole_and_finished(spark, monkeypatch):
    path = scratch_path(spark, "t")
    df = grid(spark, 400).withColumn("p", F.col("v") % 2)
    df.repartition(5).write.partitionBy("p").parquet(path)
    move = staging._move

    def killed(spark, content, path):
        raise KeyboardInterrupt  # old files are gone, new ones aren't there

    monkeypatch.setattr(staging, "_move", killed)
    with pytest.raises(KeyboardInterrupt):
        layout.pack(spark, path, ["p"])
    assert files(spark, path) == {}
    monkeypatch.setattr(staging, "_move", move)
    with pytest.raises(Exception):  # noqa: B017, PT011 - as it stands, no file is in place
        spark.read.parquet(path).count()
    with staging.writing(spark, path):
        pass
    assert rows(spark.read.parquet(path), "key", "at", "v", "p") == rows(df, "key", "at", "v", "p") and len(files(spark, path)) == 2


def test_a_task_sorts_a_bounded_number_of_bytes(spark):
    """Rows of some 90 bytes, a third of them copies of one row, and rows with nested values and long texts; all well compressed."""
    df = grid(spark, 6000).unionByName(spark.range(3000).selectExpr("'k0' AS key", "1 AS at", "1 AS v"))
    wide = df.limit(3000).select("key", "at", "v", F.lit("x" * 600).alias("text"), F.array_repeat(F.lit("y" * 30), 20).alias("list"), F.lit(None).cast("string").alias("none"))
    spark.conf.set("spark.gaugeflow.maxSortBytes", "100000")
    try:
        for given, by, most in ((df, ["key", "at"], 2000), (wide, ["key", "at"], 180), (df.where("v = 1 AND at = 1"), [], 2000)):
            path, target = scratch_path(spark, "t"), scratch_path(spark, "u")
            storage.append(given.repartition(4), path)
            storage.compact(spark, path, target, by, ["at"] if not by else [])
            got = spark.read.parquet(target)
            assert rows(got, "key", "at", "v") == rows(given, "key", "at", "v")
            sizes = [r["rows"] for r in layout.spans(got, ["v"]).collect()]
            assert max(sizes) <= most and len(sizes) <= 3 * -(-sum(sizes) // most) + 1
    finally:
        spark.conf.unset("spark.gaugeflow.maxSortBytes")
