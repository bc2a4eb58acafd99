"""Order-dependent operators that do not depend on the size of a key.

A plain ``Window.partitionBy(key)`` gives each key to one task. That is the
cheapest plan while keys are small, and it is used while the largest key has no
more rows than ``spark.gaugeflow.maxGroupRows``. Beyond that the table is cut
into *runs*: a range partitioning by (key, order) of even size, written once so
that every later pass sees the same cut. Each run is worked on by itself, and
what the runs before it contribute (a count, a sum, a last row) is carried in.
Since runs follow the order, only the first key of a run can have started in an
earlier one: the carried table has at most one row per run.

Both ways give the same rows and the same types: NULL keys are a group, rows of
equal order are told apart by a hash of the row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.runtime import MAX_FRAME_ROWS, MAX_GROUP_ROWS, limit, written

RUN, TIE = "_run", "_tie"
RUNS_PER_PARTITION = 16


@dataclass(frozen=True)
class Size:
    largest: int
    total: int
    densest: int = 0  # most rows of a key in one cell of time, where asked for

    def whole(self) -> Size:
        """The same for the table as one group."""
        return Size(self.total, self.total)


SMALL = Size(0, 0)  # for tables known to hold few rows per group


def group_size(df: DataFrame, keys: Sequence[str]) -> Size:
    """Rows of the largest group and of the table (one row reaches the driver)."""
    if not keys:
        total = df.count()
        return Size(total, total)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.coalesce(F.max("n"), F.lit(0)).alias("a"), F.coalesce(F.sum("n"), F.lit(0)).alias("b")).first()
    return Size(int(row["a"]), int(row["b"]))


def _micros(df: DataFrame, time: str) -> Column:
    """Microseconds since 1970; times without a zone are taken as they read, whatever the session's zone."""
    t = F.col(time)
    if not isinstance(df.schema[time].dataType, T.TimestampNTZType):
        return F.unix_micros(t.cast("timestamp"))
    second = (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    minutes = (F.unix_date(F.to_date(t)).cast("bigint") * 24 + F.hour(t)) * 60 + F.minute(t)
    return minutes * 60_000_000 + second


def _cell(at: Column, seconds: int) -> Column:
    length = F.lit(int(seconds) * 1_000_000)
    return ((at - F.pmod(at, length)) / length).cast("bigint")


def time_size(df: DataFrame, keys: Sequence[str], time: str, seconds: int) -> Size:
    """``group_size`` with the most rows a key has in one cell of ``seconds``."""
    cells = df.groupBy(*keys, _cell(_micros(df, time), seconds).alias("_cell")).agg(F.count(F.lit(1)).alias("n"))
    groups = cells.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("n").alias("d"))
    row = groups.agg(*[F.coalesce(f, F.lit(0)).alias(c) for f, c in ((F.max("n"), "a"), (F.sum("n"), "b"), (F.max("d"), "c"))])
    return Size(*[int(x) for x in row.first()])


def _sorted(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def _window(keys: Sequence[str], order: Sequence[str], descending: bool = False) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*_sorted(order, descending))


def _hash(df: DataFrame) -> Column:
    return F.xxhash64(*[f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))])


def _fits(df: DataFrame, size: Size) -> bool:
    return size.largest <= limit(df.sparkSession, MAX_GROUP_ROWS)


def pin_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], total: int, split_ties: bool = True) -> DataFrame:
    """Cut ``df`` into ordered runs of even size, numbered in ``_run``.

    There are as many as the limit of rows asks for, up to a multiple of the
    session's shuffle partitions: range boundaries come from a sample, and more
    runs than it can tell apart wouldn't be even. Larger runs spill.

    With ``split_ties`` rows of equal order may fall into different runs; a hash
    of the row decides, so that a repeated task cuts the same way. Without, they
    stay together, as frames that count peers need: remove copies of a reading
    first (``latest_per``).
    """
    most = RUNS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    runs = max(2, min(-(-total // limit(df.sparkSession, MAX_GROUP_ROWS)), most))
    tied = df.withColumn(TIE, _hash(df) if split_ties else F.lit(0))
    ranged = tied.repartitionByRange(runs, *[F.col(c) for c in [*keys, *order, TIE]])
    return written(ranged.withColumn(RUN, F.spark_partition_id()), "runs")


def _carry(
    pinned: DataFrame, keys: Sequence[str], parts: dict, descending: bool = False, held: DataFrame | None = None
) -> DataFrame:
    """Join to each row what earlier runs hold for its key.

    ``parts`` maps a column to (aggregate within a run, combination over runs).
    ``held`` are the rows that can have any, all by default.
    """
    per_run = (pinned if held is None else held).groupBy(RUN, *keys).agg(*[part.alias(name) for name, (part, _) in parts.items()])
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(F.col(RUN).desc() if descending else F.col(RUN))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        per_run.select(
            F.col(RUN).alias("_c_run"),
            *[F.col(k).alias(f"_c_{k}") for k in keys],
            *[combine(F.col(name)).over(earlier).alias(name) for name, (_, combine) in parts.items()],
            F.count(F.lit(1)).over(earlier).alias("_c_before"),
        )
        .filter("_c_before > 0")
        .drop("_c_before")
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys],
        F.col(RUN) == F.col("_c_run"),
    )
    return pinned.join(carried, same, "left").drop("_c_run", *[f"_c_{k}" for k in keys])


def _edges(placed: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """The first and the last row of each run by ``columns``, with ``value``, which is equal among peers.

    Only these can go on in another run, so there are two rows per run, however many values.
    """
    row = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)], F.col(value).alias("v"))
    ends = placed.groupBy(RUN).agg(F.array(F.min(row), F.max(row)).alias("_ends"))
    ends = ends.select(RUN, F.explode("_ends").alias("_end"))
    return ends.select(RUN, *[F.col(f"_end.k{i}").alias(c) for i, c in enumerate(columns)], F.col("_end.v").alias(value))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, size: Size | None = None) -> DataFrame:
    """1, 2, 3 .. within each key; rows of equal order by a hash of the row."""
    size = size or group_size(df, keys)
    if _fits(df, size):
        w = Window.partitionBy(*keys).orderBy(*_sorted(order, False), _hash(df))
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    pinned = pin_runs(df, keys, order, size.total)
    carried = _carry(pinned, keys, {"_c_n": (F.count(F.lit(1)), F.sum)})
    local = F.row_number().over(_window([RUN, *keys], [*order, TIE]))
    return carried.withColumn(name, F.coalesce("_c_n", F.lit(0)) + local).drop("_c_n", RUN, TIE)


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, str | Column],
    ahead: bool = False,
    size: Size | None = None,
) -> DataFrame:
    """Values of the row before (or, ``ahead``, after) in the order of each key.

    ``columns`` maps a new column to the column or expression to fetch.
    """
    size = size or group_size(df, keys)
    fetched = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])
    step = F.lead if ahead else F.lag
    if _fits(df, size):
        w = Window.partitionBy(*keys).orderBy(*_sorted(order, False), _hash(df))
        out = df.withColumn("_near", step(fetched, 1).over(w))
    else:
        pinned = pin_runs(df, keys, order, size.total).withColumn("_fetch", fetched)
        edge = F.struct(*order, TIE)
        part = F.min_by("_fetch", edge) if ahead else F.max_by("_fetch", edge)
        carried = _carry(pinned, keys, {"_c_near": (part, F.last)}, descending=ahead)
        local = step("_fetch", 1).over(_window([RUN, *keys], [*order, TIE]))
        out = carried.withColumn("_near", F.coalesce(local, "_c_near")).drop("_c_near", "_fetch", RUN, TIE)
    return out.select(*df.columns, *[F.col(f"_near.{n}").alias(n) for n in columns])


_COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_PART = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def _merge(kind: str, a: Column, b: Column) -> Column:
    if kind == "min":
        return F.least(a, b)
    if kind == "max":
        return F.greatest(a, b)
    return F.coalesce(a + b, a, b)


def _scan(pinned: DataFrame, keys, order, parts: dict[str, tuple[str, Column]], descending: bool) -> DataFrame:
    """Running aggregates over pinned runs (peers included)."""
    carried = _carry(
        pinned,
        keys,
        {f"_c_{n}": (_PART[kind](value), _COMBINE[kind]) for n, (kind, value) in parts.items()},
        descending,
    )
    local = _window([RUN, *keys], order, descending)
    merged = {
        n: _merge(kind, _PART[kind](value).over(local), F.col(f"_c_{n}")) for n, (kind, value) in parts.items()
    }
    return carried.withColumns(merged).drop(*[f"_c_{n}" for n in parts])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    parts: dict[str, tuple[str, Column]],
    size: Size | None = None,
) -> DataFrame:
    """Running sum / count / min / max from the first row of a key to this one and its peers."""
    size = size or group_size(df, keys)
    if _fits(df, size):
        w = _window(keys, order)
        return df.withColumns({n: _PART[kind](value).over(w) for n, (kind, value) in parts.items()})
    pinned = pin_runs(df, keys, order, size.total, split_ties=False)
    kinds = df.select(*[_PART[kind](value).alias(n) for n, (kind, value) in parts.items()]).schema
    out = _scan(pinned, keys, order, parts, False).drop(RUN, TIE)
    return out.withColumns({n: F.col(n).cast(kinds[n].dataType) for n in parts})


# ---------------------------------------------------------------- rolling frames


_FRAME = {"avg": F.avg, "sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def rolling_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    frames: dict[str, tuple[str, str, int]],
    size: Size | None = None,
) -> DataFrame:
    """Aggregates over the last ``n`` rows: ``frames`` maps a name to (aggregate, column, n).

    For hot keys, rows are numbered and cut into blocks by number. Each block
    also gets the last rows of the block before, so every frame is whole within
    its block and no block is larger than its bound.
    """
    size = size or group_size(df, keys)

    def framed(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
        w = _window(keys, order)
        return rows.withColumns(
            {name: _FRAME[fn](c).over(w.rowsBetween(-(n - 1), 0)) for name, (fn, c, n) in frames.items()}
        )

    if _fits(df, size):
        return framed(df.withColumn(TIE, _hash(df)), keys, [*order, TIE]).drop(TIE)
    halo = max(n for _, _, n in frames.values()) - 1
    block = max(limit(df.sparkSession, MAX_GROUP_ROWS), halo + 1)
    numbered = row_numbers(df, keys, order, "_n", size).withColumn("_at", F.col("_n") - 1)
    places = F.when(
        F.pmod("_at", F.lit(block)) >= block - halo, F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    spread = numbered.withColumn("_copy", F.explode(places)).withColumn(
        "_block", F.floor(F.col("_at") / block) + F.col("_copy")
    )
    return framed(spread, [*keys, "_block"], ["_n"]).filter("_copy = 0").drop("_n", "_at", "_copy", "_block")


def rolling_range(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    frames: dict[str, tuple[str, str, int]],
    size: Size | None = None,
) -> DataFrame:
    """Aggregates over the last ``seconds`` up to each row, both ends included.

    ``frames`` maps a name to (avg | sum | count | min | max, column, seconds).
    Sparse keys use Spark's own RANGE frames, all in one shuffle. Those frames
    are re-evaluated row by row, which is quadratic for dense keys, so these take
    a linear way, one frame length at a time:

    Time is cut into cells as long as the frame. The frame of a row is then the
    start of its own cell up to the row, plus the end of the cell before from
    ``seconds`` earlier on. Rows are copied into the next cell at their time
    plus ``seconds``; a running aggregate forwards over the rows and one
    backwards over the copies give the two pieces. Keys spread over their cells,
    and cells that are still too large are cut into runs.
    """
    size = size or time_size(df, keys, time, max(s for _, _, s in frames.values()))
    if size.densest <= limit(df.sparkSession, MAX_FRAME_ROWS) and _fits(df, size):
        part = "PARTITION BY " + ", ".join(f"`{k}`" for k in keys) if keys else ""
        return df.withColumns(
            {
                n: F.expr(
                    f"{fn}(`{c}`) OVER ({part} ORDER BY `{time}` "
                    f"RANGE BETWEEN INTERVAL {int(s)} SECONDS PRECEDING AND CURRENT ROW)"
                )
                for n, (fn, c, s) in frames.items()
            }
        )
    out = df
    for seconds in sorted({s for _, _, s in frames.values()}):
        of_length = {n: (fn, c) for n, (fn, c, s) in frames.items() if s == seconds}
        out = _rolling_cells(out, keys, time, seconds, of_length)
    return out.select(*df.columns, *frames)


def _rolling_cells(df, keys, time, seconds: int, frames: dict[str, tuple[str, str]]) -> DataFrame:
    length = int(seconds) * 1_000_000
    rows = df.withColumns(
        {
            "_pos": _micros(df, time),
            "_cell": _cell(_micros(df, time), seconds),
            "_copy": F.lit(False),
        }
    )
    measures = sorted({c for _, c in frames.values()})
    # rows without a time are peers of each other and in no other frame
    copies = rows.filter(F.col("_pos").isNotNull()).select(
        *keys,
        *[F.col(c) for c in measures if c not in keys],
        (F.col("_pos") + length).alias("_pos"),
        (F.col("_cell") + 1).alias("_cell"),
        F.lit(True).alias("_copy"),
    )
    both = rows.unionByName(copies, allowMissingColumns=True)
    cells = [*keys, "_cell"]
    own, before = {}, {}
    for fn, c in set(frames.values()):
        for kind in ("sum", "count") if fn == "avg" else (fn,):
            own[f"_own_{kind}_{c}"] = (kind, F.when(~F.col("_copy"), F.col(c)))
            before[f"_bef_{kind}_{c}"] = (kind, F.when(F.col("_copy"), F.col(c)))
    size = group_size(both, cells)
    if _fits(df, size):
        up, down = _window(cells, ["_pos"]), _window(cells, ["_pos"], True)
        out = both.withColumns(
            {n: _PART[k](v).over(up) for n, (k, v) in own.items()}
            | {n: _PART[k](v).over(down) for n, (k, v) in before.items()}
        )
    else:
        pinned = pin_runs(both, cells, ["_pos"], size.total, split_ties=False)
        out = _scan(_scan(pinned, cells, ["_pos"], own, False), cells, ["_pos"], before, True)

    def total(kind: str, c: str) -> Column:
        return _merge(kind, F.col(f"_own_{kind}_{c}"), F.col(f"_bef_{kind}_{c}"))

    def typed(fn: str, c: str) -> Column:
        value = total("sum", c) / F.nullif(total("count", c), F.lit(0)) if fn == "avg" else total(fn, c)
        return value.cast(df.select(_FRAME[fn](c).alias("v")).schema["v"].dataType)

    result = {n: typed(fn, c) for n, (fn, c) in frames.items()}
    return out.filter(~F.col("_copy")).withColumns(result).select(*df.columns, *frames)


# ---------------------------------------------------------------- ranks, quantiles


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    rank: str | None = None,
    percent_rank: str | None = None,
    descending: bool = False,
    size: Size | None = None,
) -> DataFrame:
    """``rank`` and ``percent_rank`` within ``keys`` (the whole table if empty).

    For hot groups, ranks count within a run plus all rows of earlier runs. A
    value that goes on from an earlier run takes the rank it got there.
    """
    size = size or group_size(df, keys)
    names = {n for n in (rank, percent_rank) if n}
    if _fits(df, size):
        w = _window(keys, [by], descending)
        out = df
        if rank:
            out = out.withColumn(rank, F.rank().over(w).cast("bigint"))
        if percent_rank:
            out = out.withColumn(percent_rank, F.percent_rank().over(w))
        return out
    pinned = pin_runs(df, keys, [by], size.total)
    before = _carry(pinned, keys, {"_c_n": (F.count(F.lit(1)), F.sum)}, descending)
    local = F.rank().over(_window([RUN, *keys], [by], descending))
    placed = before.withColumn("_rank", (F.coalesce("_c_n", F.lit(0)) + local).cast("bigint")).drop("_c_n")
    ends = _edges(placed, [*keys, by], "_rank")
    tied = _carry(placed, [*keys, by], {"_c_rank": (F.min("_rank"), F.min)}, descending, ends)
    out = tied.withColumn("_rank", F.coalesce("_c_rank", "_rank"))
    if percent_rank:
        if keys:
            out = _with_counts(out, df, keys)
        else:
            out = out.withColumn("_all", F.lit(size.total))
        out = out.withColumn(
            percent_rank, F.when(F.col("_all") > 1, (F.col("_rank") - 1) / (F.col("_all") - 1)).otherwise(0.0)
        )
    if rank:
        out = out.withColumn(rank, F.col("_rank"))
    return out.select(*df.columns, *[n for n in (rank, percent_rank) if n in names])


def _with_counts(rows: DataFrame, of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_all``, the rows that ``of`` has for the keys; NULL keys are keys."""
    counts = of.groupBy(*[F.col(k).alias(f"_s_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_all"))
    counts = written(counts, "sizes")
    if not keys:
        return rows.withColumn("_all", F.lit(counts.first()["_all"]))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys])
    return rows.join(counts, same).drop(*[f"_s_{k}" for k in keys])


def quantiles(df: DataFrame, keys: Sequence[str], column: str, points: dict[str, float], size: Size | None = None) -> DataFrame:
    """Exact interpolated quantiles per key, one row per key.

    ``percentile`` keeps the values of a group in one buffer, so it serves only
    groups of a tenth of the usual limit; for larger ones the values are numbered
    instead and the rows at the wanted places picked.
    """
    present = df.filter(F.col(column).isNotNull()).select(*keys, column)
    size = size or group_size(present, keys)
    if size.largest * 10 <= limit(df.sparkSession, MAX_GROUP_ROWS):
        return present.groupBy(*keys).agg(
            *[F.percentile(column, F.lit(p)).alias(n) for n, p in points.items()]
        )
    numbered = row_numbers(present, keys, [column], "_n", size)  # splits only groups above the limit
    placed = _with_counts(numbered, present, keys).withColumn("_at", F.col("_n") - 1)
    sides = []
    for n, p in points.items():
        place = (F.col("_all") - 1) * F.lit(p)
        low, part = F.floor(place), place - F.floor(place)
        weight = F.when(F.col("_at") == low, 1 - part).when(F.col("_at") == low + 1, part)
        sides.append(F.sum(F.when(weight > 0, F.col(column).cast("double") * weight)).alias(n))
    return placed.groupBy(*keys).agg(*sides)
