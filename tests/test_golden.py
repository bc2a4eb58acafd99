"""Small tables with known results."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gaugeflow.functions import scalars as fn
from gaugeflow.operators import checks, columns
from gaugeflow.operators.grouping import latest_per


def test_surrogate_key(spark):
    data = [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)]
    df = spark.createDataFrame(data, "a string, b string, c string")
    got = [tuple(r) for r in df.select(fn.surrogate_key("a"), fn.surrogate_key("a", "b", "c")).collect()]
    assert got == [
        ("0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164"),
    ]


def test_safe_arithmetic(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(fn.safe_add("a", "b", "c")).collect()] == [6, 4, 2, 0]
    df = spark.createDataFrame([(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(fn.safe_subtract("a", "b", "c")).collect()] == [0, 1, -2, 0]
    pairs = [(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)]
    df = spark.createDataFrame(pairs, "a int, b int")
    assert [r[0] for r in df.select(fn.safe_divide("a", "b")).collect()] == [None, 2.0, None, None, None, None, None, 0.0]


def test_width_bucket(spark):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0]
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    assert [r[0] for r in df.select(fn.bucket("a", 200000, 600000, 4)).collect()] == [0, 1, 2, 2, 3, 3, 4, 5]


def test_haversine(spark):
    at = [F.lit(x) for x in (48.864716, 2.349014, 52.379189, 4.899431)]
    km, mi = spark.range(1).select(fn.haversine(*at, unit="km"), fn.haversine(*at)).first()
    assert (round(km), round(mi)) == (430, 267)
    with pytest.raises(ValueError):
        fn.haversine(*at, unit="m")


def test_urls(spark):
    hosts = {
        "www.google.co.uk?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer": "www.google.co.uk",
        "http://witanddelight.com/2018/01/tips-tricks-how-run-half-marathon-first-time/": "witanddelight.com",
        "https://www.nytimes.com/2018/01/01/blog": "www.nytimes.com",
        "android-app://m.facebook.com/": "m.facebook.com",
        "docs.nytimes.com/2021/01/01/index.js?utm_source=google": "docs.nytimes.com",
        "https://m.facebook.com/": "m.facebook.com",
    }
    df = spark.createDataFrame([(u,) for u in hosts], "u string")
    assert [r[0] for r in df.select(fn.url_host("u")).collect()] == list(hosts.values())
    paths = {
        "www.google.co.uk?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer": "",
        "http://witanddelight.com/2018/01/tips/": "2018/01/tips/",
        "https://www.nytimes.com/2018/01/01/blog": "2018/01/01/blog",
        "http://witanddelight.com/2018/01/tips/?utm_source=google&utm_medium=cpc": "2018/01/tips/",
        "abc.com": "abc.com",
    }
    df = spark.createDataFrame([(u,) for u in paths], "u string")
    assert [r[0] for r in df.select(fn.url_path("u")).collect()] == list(paths.values())
    urls = [
        ("http://drewbanin.com/milky?utm_medium=organic",),
        ("http://drewbanin.com/milky?utm_medium=organic&utm_source=github",),
    ]
    df = spark.createDataFrame(urls, "u string")
    got = df.select(fn.url_parameter("u", "utm_medium"), fn.url_parameter("u", "utm_source")).collect()
    assert [tuple(r) for r in got] == [("organic", None), ("organic", "github")]


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_fixed_point_rounds_like_printf(spark, digits):
    values = [43.65, 48.25, 0.35, 0.05, -0.04, -1.25, 2.675, 1e6 + 0.45, 0.0, 99.95, 0.949999, -99.96, 0.1 + 0.2, 5e-17]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(fn.fixed_point(F.col("v"), digits)).collect()]
    assert got == [f"{v:.{digits}f}".replace("-" + "0." + "0" * digits, "0." + "0" * digits) for v in values]


def test_deduplicate(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    assert rows(latest_per(df, ["user_id"], "version")) == [(1, "play", 2), (2, "pause", 1)]


def test_pivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    got = columns.pivot(df, ["size"], "color", ["red", "blue", "blue's"])
    assert got.columns == ["size", "red", "blue", "blue's"]
    assert rows(got) == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_unpivot(spark):
    data = [(123, "active", "tier 1", True), (234, "active", "tier 3", False), (567, "churned", "tier 2", None)]
    df = spark.createDataFrame(data, "customer_id int, status string, segment string, is_updated boolean")
    got = columns.unpivot(df, exclude=["customer_id"], field_name="prop", value_name="val")
    assert (123, "is_updated", "true") in rows(got) and (567, "is_updated", None) in rows(got)
    assert got.count() == 9
    assert columns.unpivot(df, exclude=["customer_id"], remove=["IS_UPDATED"]).count() == 6


def test_unions(spark):
    a = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string")
    b = spark.createDataFrame([(1, "green", "7"), (2, "pink", "13")], "id int, favorite_color string, favorite_number string")
    got = columns.union_relations({"a": a, "b": b}, source_column_name=None)
    assert got.columns == ["id", "name", "favorite_number", "favorite_color"]
    assert rows(got, "id", "name", "favorite_color", "favorite_number") == sorted(
        [(1, "drew", None, "pi"), (2, "bob", None, "e"), (3, "alice", None, "4"), (1, None, "green", "7"), (2, None, "pink", "13")],
        key=repr,
    )
    assert "name" not in columns.union_relations({"a": a, "b": b}, exclude=["NAME"]).columns
    with pytest.raises(ValueError):
        columns.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        columns.union_relations({"a": a}, include=["nothing"])


def test_star_and_empty_strings(spark):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2), ("", "", 3)], "field_1 string, field_2 string, field_3 int")
    assert columns.star(df, ["FIELD_3"]).columns == ["field_1", "field_2"]
    assert columns.star(df, prefix="prefix_", suffix="_suffix").columns[0] == "prefix_field_1_suffix"
    assert rows(columns.null_empty_strings(df)) == sorted([("a", None, 1), (None, "b", 2), (None, None, 3)], key=repr)


def test_spines(spark):
    bounds = spark.sql("SELECT DATE'2018-01-01' AS a, DATE'2018-01-10' AS b")
    days = [str(r[0]) for r in columns.date_spine(bounds, "a", "b").collect()]
    assert days == [f"2018-01-0{i}" for i in range(1, 10)]
    assert columns.date_spine(spark.sql("SELECT DATE'2018-01-01' AS a, DATE'2018-01-01' AS b"), "a", "b").count() == 0
    assert rows(columns.number_series(spark, 10)) == sorted([(i,) for i in range(1, 11)], key=repr)
    with pytest.raises(ValueError):
        columns.number_series(spark, 0)


def test_column_values(spark):
    df = spark.createDataFrame([(v, c) for v, c in zip("aabbbcd", "xxyyyxy")], "field string, condition string")
    assert columns.column_values(df, "field", 2) == ["b", "a"]
    assert columns.column_values(df, "field", 9, where="condition = 'x'") == ["a", "c"]
    assert columns.column_values(df.limit(0), "field", 9, default=["z"]) == ["z"]


# ---------------------------------------------------------------- checks


def test_range_and_constants(spark):
    df = spark.createDataFrame([(-1,), (11,), (None,)], "id int")
    assert checks.accepted_range(df, "id", low=-1, high=11).count() == 0
    assert checks.accepted_range(df, "id", low=0, high=10).count() == 2
    assert checks.accepted_range(df, "id", low=-1, inclusive=False).count() == 1
    same = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "col_a int, field int")
    assert checks.not_constant(same, "col_a").count() == 1
    assert checks.not_constant(same, "field").count() == 0
    assert checks.not_constant(same, "col_a", ["field"]).count() == 2


def test_proportions(spark):
    p5 = [1, None, None, 4, 5, 6, None, None, None, 10]
    df = spark.createDataFrame([(v,) for v in p5], "point_5 int")
    assert checks.not_null_proportion(df, "point_5", 0.5).count() == 0
    assert checks.not_null_proportion(df, "point_5", 0.6).count() == 1
    assert checks.at_least_one(df, "point_5").count() == 0
    assert checks.at_least_one(df.filter("point_5 IS NULL"), "point_5").count() == 1


def test_row_counts(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "field int")
    b = spark.createDataFrame([(1,), (2,), (3,)], "field int")
    assert checks.equal_rowcount(a, b).count() == 0
    # 3 is on one side only and does not fail
    assert rows(checks.equal_rowcount(a, b, ["field"])) == [(1, 2, 1, 1)]
    assert rows(checks.fewer_rows_than(a, b), "row_count_delta") == [(1,)]
    assert rows(checks.fewer_rows_than(a, b, ["field"]), "field", "row_count_delta") == [(1, 1), (2, 1)]
    assert checks.fewer_rows_than(a.limit(2), b).count() == 0
    assert rows(checks.cardinality_equality(a, "field", b, "field")) == sorted([(1, 2), (1, 1), (3, 1)], key=repr)
    assert rows(checks.equality(a, b)) == [(3, "compare")]
    assert checks.equality(a, a).count() == 0


def test_ranges(spark):
    good = spark.createDataFrame([("a", 0, 5), ("a", 5, 9), ("b", 0, 4), ("b", 6, 8)], "k string, lo int, hi int")
    assert checks.mutually_exclusive_ranges(good, "lo", "hi", ["k"]).count() == 0
    assert rows(checks.mutually_exclusive_ranges(good, "lo", "hi", ["k"], "not_allowed"), "k", "upper_bound") == [("b", 4)]
    assert rows(checks.mutually_exclusive_ranges(good, "lo", "hi", ["k"], "required"), "k", "upper_bound") == [("a", 5)]
    bad = spark.createDataFrame([("a", 0, 6), ("a", 5, 5), ("a", None, 4)], "k string, lo int, hi int")
    assert checks.mutually_exclusive_ranges(bad, "lo", "hi", ["k"]).count() == 3
    assert checks.mutually_exclusive_ranges(bad, "lo", "hi", ["k"], zero_length=True).count() == 2
    with pytest.raises(KeyError):
        checks.mutually_exclusive_ranges(good, "lo", "hi", gaps="sometimes")


def test_sequences(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("a", 4), ("a", 4), ("b", 7)], "k string, n int")
    got = checks.sequential_values(df, "n", group_by=["k"])
    assert rows(got, "k", "n", "previous_n", "failing_rows") == [("a", 4, 2, 3)]
    days = spark.sql("SELECT explode(array(TIMESTAMP'2024-01-01', TIMESTAMP'2024-01-02', TIMESTAMP'2024-01-04')) AS d")
    assert checks.sequential_values(days, "d", 1, "day").count() == 1


def test_values_and_relations(spark):
    a = spark.createDataFrame([(1, "x"), (2, ""), (3, "  "), (None, "y"), (3, "z")], "id int, s string")
    b = spark.createDataFrame([(1, True), (2, False)], "id int, ok boolean")
    assert rows(checks.relationships_where(a, "id", b, "id")) == [(3, 2)]
    assert rows(checks.relationships_where(a, "id", b, "id", "s <> ''", "ok")) == [(3, 2)]
    assert checks.not_empty_string(a, "s").count() == 2
    assert checks.not_empty_string(a, "s", trim=False).count() == 1
    assert rows(checks.not_accepted_values(a, "id", [3, 9])) == [(3,)]
    assert rows(checks.accepted_values(a, "id", [1, 2])) == [(3, 2)]
    assert rows(checks.unique(a, "id")) == [(3, 2)]
    assert checks.not_null(a, "id").count() == 1
    assert checks.expression_is_true(a, "id < 3").count() == 2
    j = spark.createDataFrame([("{}",), ("[1",), (None,)], "s string")
    assert rows(checks.is_json(j, "s")) == [("[1",)]


def test_recency(spark):
    df = spark.sql("SELECT 'a' AS k, TIMESTAMP'2024-01-01 10:00:00' AS t UNION ALL SELECT 'b', TIMESTAMP'2024-01-02 09:00:00'")
    assert rows(checks.recency(df, "t", "hour", 12, "2024-01-02 10:00:00", group_by=["k"]), "k") == [("a",)]
    assert checks.recency(df, "t", "day", 1, "2024-01-02 10:00:00", ignore_time=True, group_by=["k"]).count() == 0


def test_runner(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    got = checks.run_checks({"nulls": checks.not_null(df, "id"), "unique": checks.unique(df, "id")})
    assert rows(got) == [("nulls", 1, "warn"), ("unique", 0, "pass")]


def test_tables_of_several_schemas(spark, tmp_path):
    for n in ("gf_one", "gf_two", "other"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {n} LOCATION '{tmp_path}/{n}'")
        spark.range(2).write.mode("overwrite").saveAsTable(f"{n}.daily_x")
    try:
        got = columns.tables_like(spark, "daily%", schemas="gf%")
        assert list(got) == ["gf_one.daily_x", "gf_two.daily_x"] and got["gf_two.daily_x"].count() == 2
    finally:
        for n in ("gf_one", "gf_two", "other"):
            spark.sql(f"DROP SCHEMA {n} CASCADE")


def test_pivot_refuses_too_many_values(spark):
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        with pytest.raises(ValueError):
            columns.pivot(spark.range(3).selectExpr("id", "id AS v"), ["id"], "v", [1, 2, 3, 4])
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_spine_is_whole_over_many_blocks(spark):
    bounds = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:30' AS a, TIMESTAMP_NTZ'2024-01-11 00:00:00' AS b, 'x' AS k")
    got = columns.date_spine(bounds, "a", "b", "minute", "t").agg(F.count("t"), F.min("t"), F.max("t"), F.count_distinct("t")).first()
    assert (got[0], got[3]) == (14400, 14400) and str(got[1]) == "2024-01-01 00:00:30" and str(got[2]) == "2024-01-10 23:59:30"
    days = columns.date_spine(spark.sql("SELECT DATE'2024-01-01' AS a, DATE'2024-01-29' AS b"), "a", "b", "week", "d")
    assert [str(r["d"]) for r in days.orderBy("d").collect()] == ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22"]
    months = columns.date_spine(spark.sql("SELECT DATE'2024-01-31' AS a, DATE'2024-04-30' AS b"), "a", "b", "month", "d")
    assert months.count() == 3
    assert columns.date_spine(spark.sql("SELECT DATE'2024-01-02' AS a, DATE'2024-01-01' AS b"), "a", "b").count() == 0
