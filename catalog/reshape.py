"""Selection, pivot, unpivot, unions, spines, joins."""

from pyspark.sql import functions as F

from catalog.base import AS_OF, NOW, TODAY, gold, observations, register, silver, table, with_gold, with_silver
from gaugeflow.operators import columns as ops
from gaugeflow.operators.grouping import join_groups, value_counts


@register("star", "SELECT c_custkey AS x_c_custkey_y, c_name AS x_c_name_y, c_mktsegment AS x_c_mktsegment_y FROM customer")
def star(spark, d):
    return ops.star(table(spark, d, "customer"), ["C_NATIONKEY", "c_acctbal"], "x_", "_y")


@register(
    "star_aggregate",
    "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity_sum FROM lineitem GROUP BY 1, 2",
    "l_quantity_sum",
)
def star_aggregate(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    keys = ops.remaining(rows, ["L_QUANTITY"])
    return rows.groupBy(*keys).agg(F.sum("l_quantity").alias("l_quantity_sum"))


@register(
    "group_by_first",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2",
)
def group_by_first(spark, d):
    rows = table(spark, d, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice")
    return ops.group_by_first(rows, 2, F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


QUERY_PART = "CASE WHEN instr(url, '?') > 0 THEN substr(url, instr(url, '?') + 1) ELSE '' END"


@register(
    "null_empty_strings",
    f"SELECT page_id, nullif({QUERY_PART}, '') AS parameters, nullif(url, '') AS url FROM pages",
)
def null_empty_strings(spark, d):
    at = F.instr("url", "?")
    rows = table(spark, d, "pages").select(
        "page_id", F.when(at > 0, F.substr("url", at + 1)).otherwise("").alias("parameters"), "url"
    )
    return ops.null_empty_strings(rows)


CONDITIONS = ["Clear", "Clouds", "Mist", "Rain", "Thunderstorm"]


@register(
    "pivot",
    with_gold(
        "SELECT city, "
        + ", ".join(f"sum(CASE WHEN weather_main = '{c}' THEN 1 ELSE 0 END) AS n_{c}_x" for c in CONDITIONS)
        + " FROM gold GROUP BY city"
    ),
    big=" ".join(f"n_{c}_x" for c in CONDITIONS),
)
def pivot(spark, d):
    """The pivoted values come from the data, most frequent first."""
    rows = gold(spark, d)
    values = ops.column_values(rows, "weather_main")
    return ops.pivot(rows, ["city"], "weather_main", values, prefix="n_", suffix="_x")


@register(
    "pivot_measure",
    with_gold(
        "SELECT observation_date, "
        + ", ".join(f"max(CASE WHEN weather_main = '{c}' THEN temperature_celsius END) AS max_{c}" for c in CONDITIONS)
        + " FROM gold GROUP BY 1"
    ),
)
def pivot_measure(spark, d):
    return ops.pivot(
        gold(spark, d).withColumn("observation_date", F.to_date("observation_time")),
        ["observation_date"],
        "weather_main",
        CONDITIONS,
        agg=F.max,
        prefix="max_",
        then=F.col("temperature_celsius"),
        otherwise=None,
    )


@register(
    "pivot_compare",
    "SELECT l_returnflag, "
    + ", ".join(
        f"count(DISTINCT CASE WHEN l_quantity >= {q} THEN l_partkey END) AS parts_from_{q}" for q in (10, 25, 40)
    )
    + " FROM lineitem GROUP BY 1",
)
def pivot_compare(spark, d):
    return ops.pivot(
        table(spark, d, "lineitem"),
        ["l_returnflag"],
        "l_quantity",
        [10, 25, 40],
        agg=F.count,
        compare=">=",
        prefix="parts_from_",
        then=F.col("l_partkey"),
        otherwise=None,
        distinct=True,
    )


@register(
    "unpivot",
    " UNION ALL ".join(
        f"SELECT c_custkey, '{c}' AS prop, CAST({c} AS VARCHAR) AS val FROM customer"
        for c in ("c_name", "c_nationkey", "c_mktsegment")
    ),
)
def unpivot(spark, d):
    return ops.unpivot(
        table(spark, d, "customer"), "string", ["c_custkey"], ["C_ACCTBAL"], field_name="prop", value_name="val"
    )


@register(
    "unpivot_boolean",
    with_silver(
        " UNION ALL ".join(
            f"SELECT city, observation_time, '{c}' AS field_name, CAST({c} AS VARCHAR) AS value FROM silver"
            for c in ("is_valid", "humidity", "weather_main")
        )
    ),
)
def unpivot_boolean(spark, d):
    rows = silver(spark, d).select("city", "observation_time", "is_valid", "humidity", "weather_main")
    return ops.unpivot(rows, exclude=["city", "observation_time"])


@register(
    "column_values",
    "SELECT p_brand, count(*) AS parts FROM part WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size > 10 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5) GROUP BY 1",
)
def column_values(spark, d):
    parts = table(spark, d, "part")
    top = ops.column_values(parts, "p_brand", max_records=5, where="p_size > 10")
    return value_counts(parts.filter(F.col("p_brand").isin(*top)), [], "p_brand", "parts")


@register("distinct_values", "SELECT DISTINCT lang, source FROM documents")
def distinct_values(spark, d):
    return ops.distinct_values(table(spark, d, "documents"), "lang", "source")


@register(
    "union_relations",
    "SELECT 'customers' AS source_relation, c_custkey, c_name AS name, CAST(c_nationkey AS BIGINT) AS nationkey, c_mktsegment, CAST(NULL AS BIGINT) AS s_suppkey FROM customer WHERE c_nationkey < 10 "
    "UNION ALL SELECT 'suppliers', NULL, s_name, CAST(s_nationkey AS BIGINT), NULL, s_suppkey FROM supplier WHERE s_nationkey < 10",
)
def union_relations(spark, d):
    customers = table(spark, d, "customer").withColumnsRenamed({"c_name": "name", "c_nationkey": "nationkey"})
    suppliers = table(spark, d, "supplier").withColumnsRenamed({"s_name": "name", "s_nationkey": "nationkey"})
    return ops.union_relations(
        {"customers": customers, "suppliers": suppliers},
        {"nationkey": "bigint"},
        exclude=["c_acctbal", "s_acctbal"],
        where="nationkey < 10",
    )


@register(
    "union_relations_include",
    "SELECT c_custkey, CAST(NULL AS BIGINT) AS s_suppkey FROM customer UNION ALL SELECT NULL, s_suppkey FROM supplier",
)
def union_relations_include(spark, d):
    return ops.union_relations(
        {"customer": table(spark, d, "customer"), "supplier": table(spark, d, "supplier")},
        include=["C_CUSTKEY", "s_suppkey"],
        source_column_name=None,
    )


@register(
    "union_tables_like",
    "SELECT 'gf_orders_' || lower(o_orderstatus) AS source_relation, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def union_tables_like(spark, d):
    """Views by status, found again by their names."""
    orders = table(spark, d, "orders")
    for status in ops.column_values(orders, "o_orderstatus"):
        orders.filter(F.col("o_orderstatus") == status).createOrReplaceTempView(f"gf_orders_{status.lower()}")
    parts = ops.tables_like(spark, "gf_orders__", prefix="gf_")
    return (
        ops.union_relations(parts)
        .groupBy("source_relation")
        .agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@register(
    "difference",
    "SELECT p_partkey AS partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 48",
)
def difference(spark, d):
    return ops.difference(
        table(spark, d, "part").select(F.col("p_partkey").alias("partkey")),
        table(spark, d, "lineitem").filter("l_quantity > 48").select(F.col("l_partkey").alias("partkey")),
    )


@register(
    "date_spine",
    "SELECT CAST(s.day AS DATE) AS date_day, count(o.o_orderkey) AS orders FROM "
    "(SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day FROM orders) AS s "
    "LEFT JOIN orders AS o ON CAST(o.o_orderdate AS DATE) = CAST(s.day AS DATE) GROUP BY 1",
)
def date_spine(spark, d):
    """Orders per day from the first to the last one, days without any included."""
    orders = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date_day"))
    spine = ops.date_spine(orders.agg(F.min("date_day").alias("a"), F.max("date_day").alias("b")), "a", "b")
    counts = orders.groupBy("date_day").agg(F.count(F.lit(1)).alias("orders"))
    return spine.join(counts, "date_day", "left").fillna(0, ["orders"])


@register(
    "hour_spine",
    "SELECT s.hour, count(e.event_id) AS events FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour FROM events) AS s "
    "LEFT JOIN events AS e ON date_trunc('hour', e.ts) = s.hour GROUP BY 1",
)
def hour_spine(spark, d):
    hours = table(spark, d, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    spine = ops.date_spine(hours.agg(F.min("hour").alias("a"), F.max("hour").alias("b")), "a", "b", "hour", "hour")
    counts = hours.groupBy("hour").agg(F.count(F.lit(1)).alias("events"))
    return spine.join(counts, "hour", "left").fillna(0, ["events"])


@register(
    "number_series",
    "SELECT n AS generated_number FROM (SELECT unnest(generate_series(1, (SELECT max(o_orderkey) FROM orders))) AS n) AS s WHERE n NOT IN (SELECT l_orderkey FROM lineitem)",
)
def number_series(spark, d):
    """Order numbers up to the highest that have no line."""
    top = table(spark, d, "orders").agg(F.max("o_orderkey").alias("n")).first()["n"]
    used = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("generated_number")).distinct()
    return ops.number_series(spark, top).join(used, "generated_number", "left_anti")


# ---------------------------------------------------------------- joins


@register(
    "join_rows_to_groups",
    "SELECT l_orderkey, l_linenumber, l_quantity, avg_quantity FROM lineitem JOIN (SELECT l_partkey, avg(l_quantity) AS avg_quantity FROM lineitem GROUP BY 1) AS a USING (l_partkey) WHERE l_quantity > 1.5 * avg_quantity",
    "avg_quantity",
)
def join_rows_to_groups(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    means = rows.groupBy("l_partkey").agg(F.avg("l_quantity").alias("avg_quantity"))
    return join_groups(rows, means, ["l_partkey"]).filter("l_quantity > 1.5 * avg_quantity").drop("l_partkey")


@register(
    "join_counts_left",
    with_gold(
        "SELECT c.city, c.date, c.n, f.latest FROM (SELECT city, observation_date AS date, count(*) AS n FROM gold "
        f"WHERE observation_time >= {TODAY} - INTERVAL 7 DAY GROUP BY 1, 2) AS c LEFT JOIN (SELECT city, max(observation_time) AS latest FROM gold "
        f"WHERE observation_time < {TODAY} - INTERVAL 1 DAY GROUP BY 1) AS f ON c.city = f.city"
    ),
)
def join_counts_left(spark, d):
    from gaugeflow.spec import since_days

    rows = gold(spark, d).select("city", "observation_time")
    counts = (
        since_days(rows, 7, AS_OF)
        .groupBy("city", F.to_date("observation_time").alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    latest = (
        rows.filter(F.col("observation_time") < F.lit("2024-01-30").cast("timestamp_ntz"))
        .groupBy("city")
        .agg(F.max("observation_time").alias("latest"))
    )
    return counts.join(latest, "city", "left")


@register(
    "join_full_outer_counts",
    "SELECT coalesce(a.k, b.k) AS nationkey, a.n AS customers, b.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1) AS a "
    "FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) AS b ON a.k = b.k",
)
def join_full_outer_counts(spark, d):
    a = table(spark, d, "customer").filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("nationkey"))
    b = table(spark, d, "supplier").filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nationkey"))
    return a.agg(F.count(F.lit(1)).alias("customers")).join(
        b.agg(F.count(F.lit(1)).alias("suppliers")), "nationkey", "full_outer"
    )


@register(
    "join_customer_orders",
    "SELECT c_custkey, c_mktsegment, n_name, count(o_orderkey) AS orders, round(sum(o_totalprice), 2) AS total FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2, 3",
)
def join_customer_orders(spark, d):
    """Orders are reduced to one row per customer before they are joined."""
    totals = (
        table(spark, d, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        table(spark, d, "customer")
        .select("c_custkey", "c_mktsegment", "c_nationkey")
        .join(nations, "c_nationkey")
        .join(totals, "c_custkey", "left")
        .fillna(0, ["orders"])
        .drop("c_nationkey")
    )


@register(
    "sorted_top_orders",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def sorted_top_orders(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@register(
    "increment_by_scalar",
    with_silver(f"SELECT city, observation_time FROM obs WHERE observation_time >= (SELECT max(observation_time) - INTERVAL 36 HOUR FROM obs) AND observation_time < {NOW}"),
)
def increment_by_scalar(spark, d):
    rows = observations(spark, d).select("city", "observation_time")
    start = rows.agg((F.max("observation_time") - F.expr("INTERVAL 36 HOURS")).alias("s")).scalar()
    now = F.lit(AS_OF).cast("timestamp_ntz")
    return rows.filter((F.col("observation_time") >= start) & (F.col("observation_time") < now))
