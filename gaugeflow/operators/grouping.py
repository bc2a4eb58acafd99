"""Group-wise operators with bounded state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deduplicate(df: DataFrame, keys: Sequence[str], *order: str | Column) -> DataFrame:
    """The first row of each key in any order, given as columns or expressions (``F.desc("t")``).

    For ``row_number() = 1`` Spark keeps one row per key already before the
    shuffle (WindowGroupLimit), so a key with very many copies sends one row per
    task and does not gather in one. Ties are broken by further columns.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")


def latest_per(df: DataFrame, keys: Sequence[str], *newest: str) -> DataFrame:
    """The row of each key that is greatest by ``newest``."""
    return deduplicate(df, keys, *[F.col(c).desc() for c in newest])


def most_common(count: str, category: str) -> Column:
    """Category of the greatest count; the smallest of equal ones.

    For the second of two grouping steps, after (key, category) counts.
    """
    return F.min(
        F.when(F.col(category).isNotNull(), F.struct((-F.col(count)).alias("n"), F.col(category).alias("c")))
    )["c"]


def value_counts(df: DataFrame, keys: Sequence[str], category: str, name: str = "occurrence_count") -> DataFrame:
    return df.groupBy(*keys, category).agg(F.count(F.lit(1)).alias(name))


def summarise(
    df: DataFrame,
    keys: Sequence[str],
    *,
    count: str = "record_count",
    averages: dict[str, str] | None = None,
    minima: dict[str, str] | None = None,
    maxima: dict[str, str] | None = None,
    modes: dict[str, str] | None = None,
    days: dict[str, str] | None = None,
) -> DataFrame:
    """Counts, averages, extremes and the most common category in one scan.

    Each argument maps an output column to its input. ``days`` counts the
    distinct dates of a time. With a category or dates, rows are first grouped
    by key and category (and date) and those sums then grouped by key: all
    state is bounded and reduced before the shuffle, where ``mode`` or a
    distinct count would carry a value table per key.
    """
    averages, minima, maxima = averages or {}, minima or {}, maxima or {}
    modes, days = modes or {}, days or {}
    if not modes and not days:
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(count),
            *[F.avg(c).alias(n) for n, c in averages.items()],
            *[F.min(c).alias(n) for n, c in minima.items()],
            *[F.max(c).alias(n) for n, c in maxima.items()],
        )
    if len(modes) > 1 or len(days) > 1:
        raise ValueError("one category and one date column at most")
    parts = {"_n": F.count(F.lit(1))}
    for c in sorted(set(averages.values())):
        parts[f"_sum_{c}"], parts[f"_cnt_{c}"] = F.sum(c), F.count(c)
    for c in sorted(set(minima.values())):
        parts[f"_min_{c}"] = F.min(c)
    for c in sorted(set(maxima.values())):
        parts[f"_max_{c}"] = F.max(c)
    source = df
    fine = list(keys)
    if modes:
        source, fine = source.withColumn("_cat", F.col(next(iter(modes.values())))), [*fine, "_cat"]
    if days:
        source, fine = source.withColumn("_day", F.to_date(next(iter(days.values())))), [*fine, "_day"]
    cells = source.groupBy(*fine).agg(*[e.alias(n) for n, e in parts.items()])

    def again(name: str) -> Column:
        fn = F.min if name.startswith("_min_") else F.max if name.startswith("_max_") else F.sum
        return fn(name)

    by_category = F.lit(True)
    if modes and days:
        # one pass over the cells for both views: totals by category, and dates
        views = [[*keys, "_cat"], [*keys, "_day"]]
        cells = cells.groupingSets(views, *fine).agg(
            *[again(n).alias(n) for n in parts], F.grouping_id().alias("_gid")
        )
        # the bit of a grouping column that is not in the set is 1; _day is the last
        by_category = F.col("_gid") == 1

    def of(view: Column, name: str) -> Column:
        fn = F.min if name.startswith("_min_") else F.max if name.startswith("_max_") else F.sum
        return fn(F.when(view, F.col(name)))

    out = [of(by_category, "_n").alias(count)]
    out += [
        F.try_divide(of(by_category, f"_sum_{c}").cast("double"), of(by_category, f"_cnt_{c}")).alias(n)
        for n, c in averages.items()
    ]
    out += [of(by_category, f"_min_{c}").alias(n) for n, c in minima.items()]
    out += [of(by_category, f"_max_{c}").alias(n) for n, c in maxima.items()]
    for n in modes:
        ranked = F.struct((-F.col("_n")).alias("n"), F.col("_cat").alias("c"))
        out.append(F.min(F.when(by_category & F.col("_cat").isNotNull(), ranked))["c"].alias(n))
    for n in days:
        seen = F.col("_day").isNotNull() & (F.col("_gid") == 2 if modes else F.lit(True))
        out.append((F.count_if(seen) if modes else F.count_distinct(F.when(seen, F.col("_day")))).alias(n))
    return cells.groupBy(*keys).agg(*out)


def share_of_group(counts: DataFrame, keys: Sequence[str], count: str, name: str = "percentage") -> DataFrame:
    """Percentage of each count within its keys.

    The window sees counts, not rows: a key has as many as it has categories.
    """
    whole = F.sum(count).over(Window.partitionBy(*keys))
    return counts.withColumn(name, F.round(F.col(count).cast("double") * 100.0 / whole, 2))


def join_groups(rows: DataFrame, groups: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows to one record per group.

    Adaptive execution broadcasts the groups where they turn out small and
    splits hot groups of the rows where they don't.
    """
    return rows.join(groups, list(on), how)
