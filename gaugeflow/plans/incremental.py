"""Marts that are kept up to date by what changed, and equal a full rebuild.

*Daily states.* Per key, day and category: the number of readings, per measure their
number and exact (decimal) sum, and the extremes with the number of readings
at them. A state takes readings in (sign 1) and back out (sign -1), and states of
categories merge into days. When the last reading at an extreme goes, the extreme is
not known from the state: that key and day alone is read again.

*Frames.* A changed reading changes the rows that look back on it. Days of a key
are numbered with their readings, so how far a change reaches (a length of time, or
a number of rows) and how far those rows look back is known from the days alone;
readings are read, and results written, for these days only.

Readings stand in a table by day, as ``streaming.pipelines`` writes it. A load is first written
down as the changes it makes, with an id: a job that dies at any point is finished by the next one, and no
change is taken in twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.operators.grouping import latest_per, most_common
from gaugeflow.operators.ordered import group_size, running
from gaugeflow.runtime import delete, written
from gaugeflow.sources import staging
from gaugeflow.sources.storage import _touched, upsert
from gaugeflow.spec import ROLES, Roles

DAY = "observation_date"
EXACT = "decimal(38, 10)"
Extremes = Mapping[str, bool]


def measures(r: Roles = ROLES) -> Extremes:
    """Measures of the daily mart, and whether their extremes are kept."""
    return {r.temperature: True, r.humidity: False, r.wind: False}


def _cell(r: Roles) -> list[str]:
    return [r.key, DAY, r.category]


def _same(prefix: str, columns: Sequence[str]) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns]


def _named(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})


def states(signed: DataFrame, of: Extremes | None = None, r: Roles = ROLES) -> DataFrame:
    """States of readings with a ``_sign``: sums take signs in; extremes are those of readings that stay, by value.

    A reading that came and went leaves no trace.
    """
    of = measures(r) if of is None else of
    cell = _cell(r)
    parts = [F.sum("_sign").alias("n")]
    for m in of:
        value = F.col(m).try_cast(EXACT)
        parts += [
            F.sum(F.when(F.col(m).isNotNull(), F.col("_sign")).otherwise(0)).alias(f"{m}_n"),
            F.coalesce(F.sum(F.when(F.col("_sign") > 0, value).otherwise(-value)), F.lit(0)).cast(EXACT).alias(f"{m}_sum"),
        ]
    out = signed.groupBy(*cell).agg(*parts)
    for m in (m for m, kept in of.items() if kept):
        net = values(signed, m, r).filter("net > 0")
        ends = net.groupBy(*cell).agg(
            F.min("value").alias(f"{m}_min"), F.min_by("net", "value").alias(f"{m}_min_n"),
            F.max("value").alias(f"{m}_max"), F.max_by("net", "value").alias(f"{m}_max_n"),
        )
        out = out.join(_named(ends, "_e_", cell), _same("_e_", cell), "left").drop(*[f"_e_{c}" for c in cell])
        out = out.withColumns({f"{m}_{e}_n": F.coalesce(f"{m}_{e}_n", F.lit(0).cast("bigint")) for e in ("min", "max")})
    return out


def values(signed: DataFrame, measure: str, r: Roles = ROLES) -> DataFrame:
    """Net number of readings per cell and value."""
    there = signed.filter(F.col(measure).isNotNull()).withColumn("value", F.col(measure))
    return there.groupBy(*_cell(r), "value").agg(F.sum("_sign").alias("net"))


def merged(old: DataFrame, signed: DataFrame, of: Extremes | None = None, r: Roles = ROLES) -> DataFrame:
    """States after some changes, with ``_open`` where an extreme has gone; cells without a reading are left out.

    ``old`` holds the states of the cells that the changes touch, and maybe others.
    """
    of = measures(r) if of is None else of
    cell = _cell(r)
    change = _named(states(signed, of, r), "_d_", [*cell, *_state_columns(of)])
    both = written(old.join(change, _same("_d_", cell), "full_outer"), "states")
    pick = {c: F.coalesce(c, f"_d_{c}") for c in cell}
    add = lambda c: F.coalesce(c, F.lit(0)) + F.coalesce(f"_d_{c}", F.lit(0))
    sums = {c: add(c).cast(EXACT if c.endswith("_sum") else "bigint") for c in ["n", *[f"{m}_{x}" for m in of for x in ("n", "sum")]]}
    ends = {f"{m}_{e}": f(F.col(f"{m}_{e}"), F.col(f"_d_{m}_{e}")) for m, kept in of.items() if kept for e, f in (("min", F.least), ("max", F.greatest))}
    out = both.select(
        *[v.alias(c) for c, v in pick.items()], *[v.alias(c) for c, v in sums.items()], *[v.alias(c) for c, v in ends.items()],
        *[F.when(F.col(c).eqNullSafe(v), F.coalesce(f"{c}_n", F.lit(0))).otherwise(0).alias(f"{c}_n") for c, v in ends.items()],
    )
    for m in (m for m, kept in of.items() if kept):
        net = _named(values(signed, m, r), "_v_", cell)
        at = out.join(net, _same("_v_", cell)).groupBy(*[f"_v_{c}" for c in cell]).agg(
            *[F.sum(F.when(F.col("value") == F.col(f"{m}_{e}"), F.col("net")).otherwise(0)).alias(f"_{e}") for e in ("min", "max")]
        )
        out = out.join(at, _same("_v_", cell), "left").withColumns(
            {f"{m}_{e}_n": (F.col(f"{m}_{e}_n") + F.coalesce(f"_{e}", F.lit(0))).cast("bigint") for e in ("min", "max")}
        ).drop("_min", "_max", *[f"_v_{c}" for c in cell])
    gone = [(F.col(f"{m}_n") > 0) & ((F.col(f"{m}_min_n") <= 0) | (F.col(f"{m}_max_n") <= 0)) for m, kept in of.items() if kept]
    empty = [F.when(F.col(f"{m}_n") > 0, F.col(f"{m}_{e}")).alias(f"{m}_{e}") for m, kept in of.items() if kept for e in ("min", "max")]
    out = out.withColumn("_open", reduce(lambda a, b: a | b, gone, F.lit(False))).filter("n > 0")
    return out.select(*cell, *[c if c not in ends else empty[list(ends).index(c)] for c in _state_columns(of)], "_open")


def _state_columns(of: Extremes) -> list[str]:
    ends = [f"{m}_{e}" for m, kept in of.items() if kept for e in ("min", "min_n", "max", "max_n")]
    return ["n", *[f"{m}_{x}" for m in of for x in ("n", "sum")], *ends]


def daily(state: DataFrame, r: Roles = ROLES) -> DataFrame:
    """The daily mart of states, as ``marts.daily_stats`` gives it for readings."""
    mean = lambda m: F.try_divide(F.sum(f"{m}_sum").cast("double"), F.sum(f"{m}_n"))
    return state.groupBy(r.key, DAY).agg(
        F.sum("n").alias("hourly_readings"),
        mean(r.temperature).alias("avg_temp"), mean(r.humidity).alias("avg_humidity"), mean(r.wind).alias("avg_wind_speed"),
        F.max(f"{r.temperature}_max").alias("max_temp"), F.min(f"{r.temperature}_min").alias("min_temp"),
        most_common("n", r.category).alias("most_common_weather"),
    )


# ---------------------------------------------------------------- loads


def signed_changes(load: DataFrame, table: DataFrame | None, newest: Sequence[str], r: Roles = ROLES) -> DataFrame:
    """What a load does to a table of readings, one a key and time: readings that come (sign 1) and that go (-1).

    Of several of a key and time the greatest by ``newest`` stays, whichever side it is from.
    Readings without a key or a time are left out: nothing could correct them.
    """
    on = [r.key, r.time]
    load = load.filter(F.col(r.key).isNotNull() & F.col(r.time).isNotNull()).withColumn(DAY, F.to_date(r.time))
    load = latest_per(load, on, *newest)
    if table is None:
        return load.withColumn("_sign", F.lit(1))
    there = _touched(table, written(load.select(DAY).distinct(), "days"), [DAY])
    there = there.select(*load.columns)
    pairs = load.select(F.struct(*load.columns).alias("new")).join(
        there.select(F.struct(*load.columns).alias("old")),
        [F.col(f"new.{c}") == F.col(f"old.{c}") for c in [*on, DAY]], "left",
    )
    newer = F.struct(*[F.col(f"new.{c}") for c in newest]) > F.struct(*[F.col(f"old.{c}") for c in newest])
    rows = F.array(F.struct(F.lit(1).alias("s"), F.col("new").alias("v")), F.struct(F.lit(-1).alias("s"), F.col("old").alias("v")))
    took = pairs.filter(F.col("old").isNull() | newer).select(F.explode(rows).alias("c")).filter("c.v IS NOT NULL")
    return took.select("c.v.*", F.col("c.s").alias("_sign"))


def load(
    source: DataFrame, readings: str, state: str, newest: Sequence[str] = (ROLES.ingest_time, ROLES.ingestion_id),
    counts: str = "is_valid", results: Mapping[str, tuple[Callable[[DataFrame], DataFrame], Sequence[tuple[str, int]]]] | None = None, r: Roles = ROLES,
) -> None:
    """Upsert readings into the table ``readings`` and bring the states, and tables of framed results, up to date.

    ``counts`` says which readings count. ``results`` maps the path of a table by day to the function that
    computes it from readings, a row for a row, and its frames: ("range", seconds) or ("rows", number). A repeated load changes nothing.
    """
    spark = source.sparkSession
    with staging.writing(spark, state):
        _resume(spark, readings, state, counts, results or {}, r)
        changes = signed_changes(source, staging.read(spark, readings), newest, r)
        home = staging.area(spark, state)
        draft = f"{home}/ready-changes"
        delete(spark, draft)
        changes.withColumn("_load", F.lit(uuid.uuid4().hex)).write.parquet(draft)
        staging.rename(spark, draft, f"{home}/changes")
        _resume(spark, readings, state, counts, results or {}, r)


def _resume(spark: SparkSession, readings: str, state: str, counts: str, results: Mapping, r: Roles) -> None:
    """Take in the changes that are written down, and forget them."""
    path = f"{staging.area(spark, state)}/changes"
    if not staging.exists(spark, path):
        return
    changes = spark.read.parquet(staging.literal(path))
    first = changes.select("_load").first()
    if first is not None:
        rows = changes.drop("_load", "_sign")
        upsert(changes.filter("_sign > 0").select(*rows.columns), readings, [r.key, r.time], [DAY], derived={DAY: F.to_date(r.time)})
        counted = changes.filter(counts)
        _merge_states(spark, counted.drop("_load"), first["_load"], readings, state, counts, r)
        for at, (compute, frames) in results.items():
            refresh(counted, readings, state, at, compute, frames, counts, r)
    delete(spark, path)


def _merge_states(spark: SparkSession, changes: DataFrame, token: str, readings: str, state: str, counts: str, r: Roles) -> None:
    """Replace the states of the days that changed. Rows carry the id of the load that wrote them: it isn't taken in again."""
    table, days = staging.read(spark, state), written(changes.select(DAY).distinct(), "days")
    if table is None:
        staging.replace(states(changes, r=r).filter("n > 0").withColumn("_load", F.lit(token)), state, [DAY])
        return
    touched = _touched(table, days, [DAY])
    if touched.filter(F.col("_load") == token).limit(1).count():
        return
    new = written(merged(touched.drop("_load"), changes, r=r), "merged")
    open_ = new.filter("_open")
    if open_.limit(1).count():
        cells = written(_named(open_.select(*_cell(r)), "_o_", _cell(r)), "cells")
        rows = _touched(staging.read(spark, readings), cells.select(F.col(f"_o_{DAY}").alias(DAY)).distinct(), [DAY])
        again = states(rows.filter(counts).join(cells, _same("_o_", _cell(r)), "left_semi").withColumn("_sign", F.lit(1)), r=r)
        new = new.filter("NOT _open").drop("_open").unionByName(again)
    staging.replace(new.drop("_open").withColumn("_load", F.lit(token)), state, [DAY], whole=False)


# ---------------------------------------------------------------- frames


def reach(days: DataFrame, changed: DataFrame, frames: Sequence[tuple[str, int]], r: Roles = ROLES) -> DataFrame:
    """Days of keys (key, day, n readings) with ``affected``: their rows look back on a changed day; and ``needed`` to compute those.

    Per day only the nearest changed day before it counts, and the nearest affected one after it: what an
    older one reaches, the nearer reaches as well.
    """
    keys = [r.key]
    size = group_size(days, keys)
    upto = running(days, keys, [DAY], {"_upto": ("sum", F.col("n"))}, size)
    mark = _named(changed.select(r.key, DAY).distinct(), "_c_", [r.key, DAY])
    placed = upto.join(mark, _same("_c_", [r.key, DAY]), "left").withColumn("_hit", F.col(f"_c_{DAY}").isNotNull())
    placed = written(placed.select(r.key, DAY, "n", "_upto", "_hit"), "days")
    back = running(placed, keys, [DAY], {"_last": ("max", F.when(F.col("_hit"), F.struct(DAY, "_upto")))}, size)
    between = F.col("_upto") - F.col("n") - F.col("_last._upto")
    affected = back.withColumn("affected", F.coalesce(_within(F.datediff(DAY, F.col(f"_last.{DAY}")), between, frames), F.lit(False)))
    ahead = affected.withColumn("_minus", -F.unix_date(DAY))
    first = F.when(F.col("affected"), F.struct(F.col("_minus"), (F.col("_upto") - F.col("n")).alias("_before")))
    ahead = running(ahead, keys, ["_minus"], {"_next": ("max", first)}, size)
    between = F.col("_next._before") - F.col("_upto")
    needed = _within(F.col("_minus") - F.col("_next._minus"), between, frames)
    return ahead.select(r.key, DAY, "affected", F.coalesce(needed, F.lit(False)).alias("needed")).filter("needed")


def _within(days: Column, between: Column, frames: Sequence[tuple[str, int]]) -> Column:
    """Whether a row may look back over so many days, with so many readings strictly between the two days."""
    reached = [days * 86_400 < F.lit(length + 86_400) if kind == "range" else between < length for kind, length in frames]
    return reduce(lambda a, b: a | b, reached)


def refresh(
    changes: DataFrame, readings: str, state: str, path: str, compute: Callable[[DataFrame], DataFrame],
    frames: Sequence[tuple[str, int]], counts: str = "is_valid", r: Roles = ROLES,
) -> None:
    """Bring a table of framed results, by day, up to date after changes that the readings and states hold already."""
    spark, on = changes.sparkSession, [r.key, DAY]
    changed = written(changes.select(*on).distinct(), "changed")
    # a day all whose readings went has no state any more, but rows to remove and followers to compute
    known = staging.read(spark, state).join(_named(changed.select(r.key).distinct(), "_k_", [r.key]), _same("_k_", [r.key]), "left_semi")
    days = known.select(*on, "n").unionByName(changed.withColumn("n", F.lit(0).cast("bigint"))).groupBy(*on).agg(F.sum("n").alias("n"))
    found = written(reach(days, changed, frames, r), "reach")
    rows = _touched(staging.read(spark, readings).filter(counts), found.select(DAY).distinct(), [DAY])
    rows = rows.join(_named(found.select(*on), "_f_", on), _same("_f_", on), "left_semi").drop(DAY)
    hit = written(_named(found.filter("affected").select(*on), "_a_", on), "affected")
    fresh = compute(rows).withColumn(DAY, F.to_date(r.time)).join(hit, _same("_a_", on), "left_semi")
    with staging.writing(spark, path):
        table = staging.read(spark, path)
        if table is None:
            staging.replace(fresh, path, [DAY])
            return
        kept = _touched(table, hit.select(F.col(f"_a_{DAY}").alias(DAY)).distinct(), [DAY]).join(hit, _same("_a_", on), "left_anti")
        staging.replace(kept.unionByName(fresh), path, [DAY], whole=False)
