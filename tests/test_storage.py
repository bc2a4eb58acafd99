"""Tables under writers that die, writers at the same time, readers, and neighbours."""

import re
import threading
import time
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gaugeflow.runtime import delete, scratch_path
from gaugeflow.sources import staging, storage
from gaugeflow.sources.schemas import TABLES

KEYS = ["city", "observation_time"]


def frame(spark, data):
    return spark.createDataFrame(data, "city string, observation_time int, v int")


@pytest.fixture()
def short_lease(spark):
    spark.conf.set("spark.gaugeflow.leaseSeconds", "1")
    yield
    spark.conf.unset("spark.gaugeflow.leaseSeconds")


def die(*args, **kwargs):
    raise KeyboardInterrupt


@pytest.mark.parametrize("partition_by", [[], ["city"]])
def test_a_committed_replacement_is_read_and_finished(spark, partition_by, monkeypatch):
    path = scratch_path(spark, "t")
    storage.upsert(frame(spark, [("a", 1, 1), ("b", 1, 3)]), path, KEYS, partition_by)
    put = staging.put

    def killed(spark, path, change):
        # the worst moment: the new content is committed, the old one is gone
        delete(spark, f"{path}/city=a" if partition_by else path)
        raise KeyboardInterrupt

    monkeypatch.setattr(staging, "put", killed)
    with pytest.raises(KeyboardInterrupt):
        storage.upsert(frame(spark, [("a", 1, 10), ("a", 2, 20)]), path, KEYS, partition_by)
    monkeypatch.setattr(staging, "put", put)
    want = [("a", 1, 10), ("a", 2, 20), ("b", 1, 3)]
    for _ in range(2):  # readers see the new content and change nothing
        assert rows(storage.read_if_present(spark, path), *KEYS, "v") == want
    assert staging.ready(spark, path) is not None
    storage.upsert(frame(spark, [("a", 1, 10), ("a", 2, 20)]), path, KEYS, partition_by)
    assert staging.ready(spark, path) is None and rows(spark.read.parquet(path), *KEYS, "v") == want


def test_content_that_was_not_committed_is_dropped_by_the_next_writer(spark, monkeypatch):
    path = scratch_path(spark, "t")
    storage.overwrite(frame(spark, [("a", 1, 1)]), path)
    monkeypatch.setattr(staging, "commit", die)
    with pytest.raises(KeyboardInterrupt):
        storage.overwrite(frame(spark, [("z", 1, 1)]), path)
    monkeypatch.undo()
    home = staging.area(spark, path)
    left = [str(f.getPath().getName()) for f in staging._fs(spark, home).listStatus(staging._path(spark, home))]
    assert [n[:8] for n in left] == ["content-"]
    assert rows(storage.read_if_present(spark, path)) == [("a", 1, 1)] and staging.exists(spark, f"{home}/{left[0]}")
    storage.append(frame(spark, [("b", 1, 1)]), path)
    assert not staging.exists(spark, f"{home}/{left[0]}") and rows(spark.read.parquet(path), *KEYS, "v") == [("a", 1, 1), ("b", 1, 1)]


def test_neighbours_with_like_names_are_left_alone(spark):
    path = scratch_path(spark, "daily")
    names = [path, path + ".next_week", path + ".next", path + "+city", path + "-content"]
    for i, p in enumerate(names):
        storage.overwrite(frame(spark, [(f"t{i}", k, k) for k in range(i + 1)]), p)
    for _ in range(2):
        for i, p in enumerate(names):
            assert storage.read_if_present(spark, p).count() == i + 1
        storage.append(frame(spark, []), path)
        storage.upsert(frame(spark, [("t0", 0, 0)]), path, KEYS)


def test_a_reader_during_a_write_sees_the_old_table_and_removes_nothing(spark):
    path = scratch_path(spark, "t")
    storage.overwrite(frame(spark, [("a", 1, 1)]), path)
    with staging.writing(spark, path) as lease:
        content = staging.content_path(spark, path)
        frame(spark, [("a", 1, 2)]).write.parquet(content)
        delete(spark, f"{content}/_SUCCESS")  # still being written
        assert rows(storage.read_if_present(spark, path)) == [("a", 1, 1)] and staging.exists(spark, content)
        staging.commit(spark, path, staging.Ready(content, "table"), lease)
    assert rows(storage.read_if_present(spark, path)) == [("a", 1, 2)]


@pytest.mark.parametrize("name", ["t[1]", "t{a,b}", "t*", "t?x"])
def test_names_that_look_like_patterns(spark, name):
    path = scratch_path(spark, "odd") + "/" + name
    storage.upsert(frame(spark, [("a", t, t) for t in range(10)]), path, KEYS, ["city"])
    storage.upsert(frame(spark, [("a", 3, 33)]), path, KEYS, ["city"])
    storage.insert_new(frame(spark, [("a", 3, 5), ("b", 11, 11)]), path, "observation_time", ["city"])
    got = storage.read_if_present(spark, path)
    assert rows(got, *KEYS, "v") == sorted([("a", t, {3: 33}.get(t, t)) for t in range(10)] + [("b", 11, 11)], key=repr)


def test_a_table_may_not_take_the_reserved_name(spark):
    for path in (scratch_path(spark, "x") + "/_staged", scratch_path(spark, "x") + "/_staged/t"):
        with pytest.raises(ValueError):
            storage.append(frame(spark, []), path)


def test_inserted_rows_without_a_key_count_once(spark):
    path = scratch_path(spark, "t")
    load = [(None, 1, 1), (None, 1, 1), (None, 2, None), ("a", 1, 1)]
    for _ in range(3):
        storage.insert_new(frame(spark, load), path, "city")
    assert rows(spark.read.parquet(path), *KEYS, "v") == sorted([(None, 1, 1), (None, 2, None), ("a", 1, 1)], key=repr)
    wider = spark.createDataFrame([(None, 1, 1, None), (None, 1, 1, "new"), ("a", 1, 1, "x"), ("b", 1, 1, "x")], "city string, observation_time int, v int, more string")
    for _ in range(2):
        storage.insert_new(wider, path, "city")
    assert rows(storage.read_if_present(spark, path), "city", "v", "more") == sorted(
        [(None, 1, None), (None, None, None), ("a", 1, None), (None, 1, "new"), ("b", 1, "x")], key=repr
    )


def test_a_dead_writers_lease_is_taken_over(spark, short_lease):
    path = scratch_path(spark, "t")
    storage.overwrite(frame(spark, [("a", 1, 1)]), path)
    staging._write(spark, f"{staging.area(spark, path)}/lease", "a writer that was killed")
    begun = time.time()
    storage.append(frame(spark, [("b", 1, 1)]), path)
    assert time.time() - begun >= 0.5 and spark.read.parquet(path).count() == 2


def test_a_living_writer_is_waited_for_and_one_taken_over_does_not_commit(spark, short_lease):
    path = scratch_path(spark, "t")
    storage.overwrite(frame(spark, [("a", 1, 1)]), path)
    failed = []

    def other():
        try:
            with staging.writing(spark, path, wait=1.5):
                pass
        except staging.TableBusy as e:
            failed.append(e)

    with staging.writing(spark, path) as lease:
        thread = threading.Thread(target=other)
        thread.start()
        thread.join()
        assert len(failed) == 1  # the lease was renewed all the while
        delete(spark, lease.file)
        staging._write(spark, lease.file, "somebody else")
        with pytest.raises(staging.TableBusy):
            storage.overwrite(frame(spark, [("a", 1, 2)]), path)
    assert rows(spark.read.parquet(path)) == [("a", 1, 1)] and staging._read(spark, lease.file) == "somebody else"


def test_folders_of_a_table_do_not_grow_with_its_keys(spark):
    """``create_tables`` over 300 keys, some users without a number."""
    from catalog import QUERIES

    data = [(i, datetime(2024, 1, 1) + timedelta(minutes=i), i % 300 if i % 7 else None, "view", float(i % 90), '{"k": 5}') for i in range(900)]
    events = spark.createDataFrame(data, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    d = scratch_path(spark, "given")
    events.write.parquet(f"{d}/events.parquet")
    got = QUERIES["create_tables"].plan(spark, d)
    assert len({f.rpartition("/")[0] for f in got.inputFiles()}) <= 64
    want = events.select(F.concat(F.lit("station-"), "user_id"), "ts", "value", (F.col("value") <= 60) & (F.col("event_id") % 170 <= 150) & ((F.col("event_id") % 350 + 780).between(800, 1100)))
    assert rows(got) == rows(want)


def test_a_key_is_read_from_its_folder_alone(spark):
    kind, path = TABLES["trend"], scratch_path(spark, "trend")
    columns = storage.create_table(spark, "trend", path).drop(*kind.derived)
    cities = [None, "", "a/b=c%", "New York", *(f"c{i}" for i in range(200))]
    df = spark.createDataFrame([(c, float(i)) for i, c in enumerate(cities * 3)], "city string, temperature_celsius double")
    df = df.select(*[c if c in df.columns else F.lit(None).cast(columns.schema[c].dataType).alias(c) for c in columns.columns])
    storage.append(df, path, kind.partition_by, kind.derived, kind.order)
    storage.append(df.limit(0), path, kind.partition_by, kind.derived, kind.order)
    table = storage.create_table(spark, "trend", path)
    assert rows(table, "city", "temperature_celsius") == rows(df, "city", "temperature_celsius")
    for city in (None, "", "a/b=c%", "c7"):
        one = table.where(kind.holds(city))
        assert rows(one, "temperature_celsius") == rows(df.where(F.col("city").eqNullSafe(F.lit(city).cast("string"))), "temperature_celsius")
        assert re.search(r"PartitionFilters: \[[^]]*city_bucket#\d+ = \d+", one._jdf.queryExecution().executedPlan().toString())
    # an upsert knows the folder of a key as well
    change = df.where("city = 'c7'").limit(1).withColumns({"observation_time": F.lit(datetime(2024, 1, 1)), "temperature_celsius": F.lit(-1.0)})
    for _ in range(2):
        storage.upsert(change, path, ["city", "observation_time"], kind.partition_by, schema=kind.stored, derived=kind.derived)
    table = storage.create_table(spark, "trend", path)
    assert rows(table.where(kind.holds("c7")), "temperature_celsius").count((-1.0,)) == 1 and table.where("city = 'c8'").count() == 3
