"""Column selection, renaming, reshaping and unions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def remaining(df: DataFrame, except_: Sequence[str] = ()) -> list[str]:
    """Column names but some, compared without case."""
    out = {c.lower() for c in except_}
    return [c for c in df.columns if c.lower() not in out]


def star(df: DataFrame, except_: Sequence[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but some, renamed."""
    return df.select([F.col(f"`{c}`").alias(f"{prefix}{c}{suffix}") for c in remaining(df, except_)])


def null_empty_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty text as NULL, in all text columns or the given ones."""
    texts = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def group_by_first(df: DataFrame, n: int, *aggregates: Column) -> DataFrame:
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n]).agg(*aggregates)


def pivot(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    values: Sequence,
    agg=F.sum,
    compare: str = "=",
    prefix: str = "",
    suffix: str = "",
    then: Column | int = 1,
    otherwise: Column | int | None = 0,
    distinct: bool = False,
) -> DataFrame:
    """One conditional aggregate per value, in a single grouping.

    More values than ``spark.sql.pivotMaxValues`` are refused, none is left out.
    """
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    if len(values) > most:
        raise ValueError(f"{len(values)} values to pivot, more than spark.sql.pivotMaxValues ({most})")
    tests = {
        "=": lambda c, v: c == v,
        "!=": lambda c, v: c != v,
        ">": lambda c, v: c > v,
        ">=": lambda c, v: c >= v,
        "<": lambda c, v: c < v,
        "<=": lambda c, v: c <= v,
    }
    then, otherwise = (x if isinstance(x, Column) else F.lit(x) for x in (then, otherwise))
    cells = {}
    for v in values:
        cell = F.when(tests[compare](F.col(column), F.lit(v)), then).otherwise(otherwise)
        if distinct:
            cell = F.count_distinct(cell) if agg is F.count else F.sum_distinct(cell) if agg is F.sum else agg(cell)
        else:
            cell = agg(cell)
        cells[f"{prefix}{v}{suffix}"] = cell
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in cells.items()])


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows in one scan; ``exclude`` columns are kept, ``remove`` columns dropped."""
    melted = remaining(df, [*exclude, *remove])
    cast = df.select(*exclude, *[F.col(f"`{c}`").cast(cast_to).alias(c) for c in melted])
    return cast.unpivot(list(exclude), melted, field_name, value_name)


def column_values(
    df: DataFrame | None,
    column: str,
    max_records: int | None = None,
    order_by: Column | None = None,
    where: Column | str | None = None,
    default: Sequence | None = None,
) -> list:
    """Distinct values, the most frequent first unless ordered otherwise, as a list.

    For naming the columns of a pivot; ``max_records`` keeps the first ones only.
    Without a table, or without any row, the default is returned.
    """
    if df is None:
        return list(default or [])
    source = df if where is None else df.filter(where)
    counts = source.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(*([order_by] if order_by is not None else []), F.desc("n"), "value")
    found = [r["value"] for r in (ordered if max_records is None else ordered.limit(max_records)).collect()]
    return found or list(default or [])


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def union_relations(
    relations: dict[str, DataFrame],
    column_override: dict[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = "source_relation",
    where: str | None = None,
) -> DataFrame:
    """Union of unlike tables: all their columns, NULL where a table lacks one."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override, kept = column_override or {}, {c.lower() for c in include}
    types: dict[str, str] = {}
    parts = []
    for label, df in relations.items():
        names = remaining(df, exclude) if not include else [c for c in df.columns if c.lower() in kept]
        for f in df.schema:
            if f.name in names:
                types.setdefault(f.name, override.get(f.name, f.dataType.simpleString()))
        parts.append((label, df if where is None else df.filter(where), set(names)))
    if not types:
        raise ValueError("no columns to union")
    out = None
    for label, df, names in parts:
        columns = [
            (F.col(f"`{c}`") if c in names else F.lit(None)).cast(kind).alias(c) for c, kind in types.items()
        ]
        if source_column_name:
            columns.insert(0, F.lit(label).alias(source_column_name))
        part = df.select(*columns)
        out = part if out is None else out.unionByName(part)
    return out


def tables_like(
    spark: SparkSession, pattern: str = "%", exclude: str | None = None, prefix: str = "", schemas: str | None = None
) -> dict[str, DataFrame]:
    """Registered tables and views by prefix and SQL pattern (``%``, ``_``), in name order.

    Of the current schema, by their names; with a pattern for ``schemas`` of all
    schemas that it fits, as ``schema.table``.
    """

    def matcher(sql: str):
        return re.compile("".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in sql), re.I)

    want, skip = matcher(pattern), matcher(exclude) if exclude else None
    if schemas is not None:
        fits = [s.name for s in spark.catalog.listDatabases() if matcher(schemas).fullmatch(s.name)]
        there = sorted((s, t.name) for s in fits for t in spark.catalog.listTables(s) if not t.isTemporary)
        return {
            f"{s}.{n}": spark.table(f"`{s}`.`{n}`")
            for s, n in there
            if n.startswith(prefix) and want.fullmatch(n) and not (skip and skip.fullmatch(n))
        }
    names = sorted(t.name for t in spark.catalog.listTables())
    return {
        n: spark.table(n)
        for n in names
        if n.startswith(prefix) and want.fullmatch(n) and not (skip and skip.fullmatch(n))
    }


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` lacks.

    Both sides are reduced to distinct rows first, so copies do not reach the join.
    """
    return a.distinct().subtract(b.select(*a.columns).distinct())


FIXED_UNITS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400, "week": 604_800}
SPINE_BLOCK = 4_096


def date_spine(bounds: DataFrame, start: str, end: str, unit: str = "day", name: str = "date_day") -> DataFrame:
    """Times from ``start`` (included) to ``end`` (excluded) in steps of ``unit``.

    ``bounds`` is a one-row table of the two ends, so they may come from data.
    Its other columns are kept. Steps of a fixed length are numbered in two levels, so that no
    array holds the whole series.
    """
    kind, unit = bounds.schema[start].dataType, unit.lower()
    rest = [c for c in bounds.columns if c not in (start, end)]
    if unit in FIXED_UNITS and not (isinstance(kind, T.DateType) and FIXED_UNITS[unit] < 86_400):
        length = FIXED_UNITS[unit]
        if isinstance(kind, T.DateType):
            steps, value = F.datediff(end, start) / (length // 86_400), F.expr(f"date_add(`{start}`, CAST(_i * {length // 86_400} AS INT))")
        else:
            # one step more: clocks may have been changed in between
            steps = F.timestamp_diff("SECOND", F.col(start), F.col(end)) / length + 1
            value = F.timestamp_add(unit.upper(), F.col("_i").cast("int"), F.col(start))
        blocks = F.when(F.col(end) > F.col(start), F.sequence(F.lit(0).cast("bigint"), F.floor(steps / SPINE_BLOCK)))
        places = F.sequence(F.col("_b") * SPINE_BLOCK, F.col("_b") * SPINE_BLOCK + SPINE_BLOCK - 1)
        numbered = bounds.withColumn("_b", F.explode(blocks)).withColumn("_i", F.explode(places))
        line = numbered.select(*rest, F.col(end).alias("_end"), value.cast(kind).alias(name))
        return line.filter(F.col(name) < F.col("_end")).drop("_end")
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    line = F.when(F.col(end) > F.col(start), F.sequence(F.col(start), F.col(end), step))
    return bounds.select(*rest, F.explode(F.filter(line, lambda x: x < F.col(end))).alias(name))


def number_series(spark: SparkSession, upper: int, name: str = "generated_number") -> DataFrame:
    """1 .. ``upper``."""
    if upper < 1:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).withColumnRenamed("id", name)
