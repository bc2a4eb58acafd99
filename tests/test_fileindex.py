"""Zone maps and Bloom filters per file."""

import random

from conftest import rows

from gaugeflow.runtime import scratch_path
from gaugeflow.sources import fileindex, layout, storage


def table(spark, data):
    return spark.createDataFrame(data, "k string, v int")


def test_files_that_hold_a_key_are_found_and_few_others(spark):
    rng = random.Random(3)
    path = scratch_path(spark, "odd [1]") + "/t"
    keys = [f"id-{rng.randrange(10**9)}" for _ in range(20_000)] + [None] * 50
    table(spark, [(k, i) for i, k in enumerate(keys)]).repartition(40).write.parquet(path)
    assert fileindex.refresh(spark, path, "k") == 40 and fileindex.refresh(spark, path, "k") == 0
    asked = keys[:3] + ["id-none", None]
    there = spark.read.parquet(path.replace("[", "\\[").replace("]", "\\]"))
    holding = {r[0] for r in there.where(there.k.isin(keys[:3])).select("_metadata.file_name").distinct().collect()}
    got = {f.rsplit("/", 1)[1] for f in fileindex.files_for(spark, path, "k", table(spark, [(k, 0) for k in asked]))}
    assert holding <= got and len(got) <= len(holding) + 8
    # share of files opened in vain, over keys that aren't there
    vain = sum(len(fileindex.files_for(spark, path, "k", table(spark, [(f"id-{rng.randrange(10**9)}x", 0)]))) for _ in range(8))
    assert vain <= 0.1 * 8 * 40


def test_entries_follow_the_files(spark):
    path = scratch_path(spark, "t")
    for i in range(3):
        table(spark, [(f"k{i}-{j}", j) for j in range(50)]).coalesce(1).write.mode("append").parquet(path)
        assert fileindex.refresh(spark, path, "k") == 1
    assert len(fileindex.files_for(spark, path, "k", table(spark, [("k1-7", 0)]))) == 1
    layout.pack(spark, path)
    assert fileindex.refresh(spark, path, "k") == 1
    assert len(fileindex.files_for(spark, path, "k", table(spark, [("k1-7", 0), ("k2-9", 0)]))) == 1
    assert fileindex.files_for(spark, path, "k", table(spark, [(None, 0)])) == []


def test_indexed_inserts_add_each_key_once(spark):
    path = scratch_path(spark, "t")
    data = [(f"k{i}", i) for i in range(300)] + [(None, 1)]
    for part in (data[:200], data[100:], data, data):
        storage.insert_new(table(spark, part), path, "k", indexed=True)
    assert rows(spark.read.parquet(path)) == sorted(data, key=repr)
