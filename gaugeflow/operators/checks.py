"""Declarative data tests: each returns the rows that fail.

A line may stand for several failing rows; it then has their number in
``failing_rows``, which the runner sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gaugeflow.operators.columns import difference
from gaugeflow.operators.ordered import Size, group_size, neighbour
from gaugeflow.runtime import scratch_path
from gaugeflow.spec import anchor


def _fails(condition: Column) -> Column:
    """True only where the condition is false; NULL passes."""
    return F.coalesce(~condition, F.lit(False))


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    c = F.col(column)
    ok = F.lit(True)
    if low is not None:
        ok = ok & (c >= low if inclusive else c > low)
    if high is not None:
        ok = ok & (c <= high if inclusive else c < high)
    return df.filter(_fails(ok))


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups without a single value."""
    return df.groupBy(*group_by).agg(F.count(column).alias("non_null")).filter("non_null = 0")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values whose number of rows differs between two tables."""
    a = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    b = to.groupBy(F.col(field).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    return a.subtract(b).unionByName(b.subtract(a))


def _group_counts(a: DataFrame, b: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Row counts of two tables side by side, one line per group."""
    keys = [F.col(c) for c in group_by] or [F.lit(1).alias("_one")]
    left = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("count_a"))
    right = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("count_b"))
    return left.join(right, list(group_by) or "_one", "full_outer").drop("_one")


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups whose row counts differ; a group on one side only does not fail."""
    counts = _group_counts(df, compare, group_by)
    return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b"))).filter("diff_count > 0")


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups that are not smaller than in the other table; an equal count fails by 1."""
    delta = F.col("count_a") - F.col("count_b")
    counts = _group_counts(df, compare, group_by)
    return counts.withColumn(
        "row_count_delta", F.when(delta > 0, delta).when(delta == 0, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    ).filter("row_count_delta > 0")


def equality(df: DataFrame, compare: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows on one side only, with the side they are on.

    The test's number of failures is that of ``equality_failures``.
    """
    names = list(columns or df.columns)
    a, b = df.select(*names), compare.select(*names)
    return (
        difference(a, b)
        .withColumn("only_in", F.lit("model"))
        .unionByName(difference(b, a).withColumn("only_in", F.lit("compare")))
    )


def equality_failures(failing: DataFrame) -> Column:
    """Rows on one side only, plus how many more one side has of them than the other."""
    side = F.sum(F.when(F.col("only_in") == "model", 1).otherwise(-1))
    return F.count(F.lit(1)) + F.coalesce(F.abs(side), F.lit(0))


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    return df.filter(_fails(F.expr(expression) if isinstance(expression, str) else expression))


def mutually_exclusive_ranges(
    df: DataFrame,
    low: str,
    high: str,
    partition_by: Sequence[str] = (),
    gaps: str = "allowed",
    zero_length: bool = False,
    size: Size | None = None,
) -> DataFrame:
    """Ranges that are empty or backward, or that meet the next one wrongly."""
    meets = {
        "allowed": lambda end, start: end <= start,
        "not_allowed": lambda end, start: end == start,
        "required": lambda end, start: end < start,
    }[gaps]
    ranges = df.select(*partition_by, F.col(low).alias("lower_bound"), F.col(high).alias("upper_bound"))
    near = neighbour(
        ranges,
        list(partition_by),
        ["lower_bound", "upper_bound"],
        {"next_lower_bound": "lower_bound", "_more": F.lit(True)},
        ahead=True,
        size=size,
    )
    start, end = F.col("lower_bound"), F.col("upper_bound")
    proper = F.coalesce(start <= end if zero_length else start < end, F.lit(False))
    follows = F.coalesce(meets(end, F.col("next_lower_bound")), F.col("_more").isNull(), F.lit(False))
    return near.filter(~(proper & follows)).drop("_more")


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.select(F.col(column).alias("value_field")).filter(F.col("value_field").isin(*values)).distinct()


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their number of rows."""
    return (
        df.filter(_fails(F.col(column).isin(*values)))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups with exactly one distinct value; minimum and maximum tell it without a distinct."""
    same = (F.min(column) == F.max(column)).alias("_same")
    return (
        df.groupBy(*group_by).agg(same).filter("_same").drop("_same").withColumn("filler_column", F.lit(1).cast("bigint"))
    )


def not_empty_string(df: DataFrame, column: str, trim: bool = True) -> DataFrame:
    text = F.trim(F.col(column)) if trim else F.col(column)
    return df.filter(text == "")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()
) -> DataFrame:
    share = F.try_divide(F.count(column).cast("double"), F.count(F.lit(1))).alias("not_null_proportion")
    p = F.col("not_null_proportion")
    return df.groupBy(*group_by).agg(share).filter((p < at_least) | (p > at_most))


def recency(
    df: DataFrame,
    field: str,
    unit: str,
    interval: int,
    as_of: str | datetime | None = None,
    ignore_time: bool = False,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Groups whose newest row is older than ``interval`` units before the anchor."""
    threshold = anchor(as_of, df, field) - F.expr(f"INTERVAL {int(interval)} {unit.upper()}")
    newest = F.max(field)
    if ignore_time:
        threshold, newest = F.to_date(threshold), F.to_date(newest)
    return (
        df.groupBy(*group_by)
        .agg(newest.alias("most_recent"))
        .withColumn("threshold", threshold)
        .filter(F.col("most_recent") < F.col("threshold"))
    )


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str = "true",
    to_condition: str = "true",
) -> DataFrame:
    """Values without a partner, with the number of rows that fail.

    The values looked for are counted first, so that a value with very many
    rows crosses the join once.
    """
    left = df.filter(from_condition).filter(F.col(column).isNotNull())
    right = to.filter(to_condition).select(F.col(field).alias(column)).distinct()
    counted = left.groupBy(column).agg(F.count(F.lit(1)).alias("failing_rows"))
    return counted.join(right, column, "left_anti")


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    unit: str | None = None,
    group_by: Sequence[str] = (),
    size: Size | None = None,
) -> DataFrame:
    """Values that do not follow the one before by ``interval``, with the number of rows failing.

    Equal values are counted before they are ordered. Each value after the first
    of its kind follows itself and fails.
    """
    by = list(group_by)
    counted = df.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    size = size or group_size(df, by)  # an upper bound for the distinct values
    near = neighbour(counted, by, [column], {f"previous_{column}": column}, size=size)
    previous = F.col(f"previous_{column}")
    due = previous + (F.expr(f"INTERVAL {int(interval)} {unit.upper()}") if unit else F.lit(interval))
    wrong = _fails(F.col(column) == due)
    same_fails = interval != 0
    failing = wrong.cast("bigint") + (F.col("_n") - 1 if same_fails else F.lit(0))
    return near.withColumn("failing_rows", failing).drop("_n").filter("failing_rows > 0")


def unique_combination(df: DataFrame, columns: Sequence[str], count: str = "n_records") -> DataFrame:
    """Combinations held by more than one row, with their number."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) > 1)


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def is_json(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & F.try_parse_json(F.col(column)).isNull())


def run_checks(tests: dict[str, DataFrame], severity: str = "warn") -> DataFrame:
    """One row per test: failing rows and status."""
    out = None
    for name, failing in tests.items():
        if "only_in" in failing.columns:
            number = equality_failures(failing)
        elif "failing_rows" in failing.columns:
            number = F.coalesce(F.sum("failing_rows"), F.lit(0))
        else:
            number = F.count(F.lit(1))
        row = failing.agg(number.cast("bigint").alias("failures")).select(F.lit(name).alias("test"), "failures", _status(severity))
        out = row if out is None else out.unionByName(row)
    return out


def _status(severity: str) -> Column:
    return F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit(severity)).alias("status")


def run_row_checks(df: DataFrame, conditions: dict[str, Column], severity: str = "warn") -> DataFrame:
    """Tests that look at one row at a time, all in one scan: conditions that must not be false (NULL passes)."""
    counts = df.agg(*[F.count(F.when(_fails(c), 1)).alias(n) for n, c in conditions.items()])
    lines = counts.unpivot([], list(conditions), "test", "failures")
    return lines.select("test", "failures", _status(severity))


class Watched:
    """Row checks that are counted while the rows are written, without a scan of their own.

    Write ``rows`` with one action, then ask for ``result``.
    """

    def __init__(self, df: DataFrame, conditions: dict[str, Column], severity: str = "warn"):
        self._spark, self._names, self._severity = df.sparkSession, list(conditions), severity
        self._seen = Observation()
        counts = [F.count(F.when(_fails(c), 1)).alias(f"_{i}") for i, c in enumerate(conditions.values())]
        self.rows = df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *counts)

    @property
    def rows_written(self) -> int:
        return self._seen.get["rows"]

    def result(self) -> DataFrame:
        """One row per check, as ``run_row_checks`` gives it; waits for the write."""
        got = self._seen.get
        lines = self._spark.createDataFrame([(n, got[f"_{i}"]) for i, n in enumerate(self._names)], "test string, failures bigint")
        return lines.select("test", "failures", _status(self._severity))


def store_failures(tests: dict[str, DataFrame], folder: str | None = None) -> dict[str, str]:
    """Write the failing rows of each test; returns where. Read them back to count them without computing them again."""
    places = {}
    for name, failing in tests.items():
        places[name] = f"{folder}/{name}" if folder else scratch_path(failing.sparkSession, f"failures-{name}")
        failing.write.mode("overwrite").parquet(places[name])
    return places
