"""Quantiles and distinct counts over any look-back, from one small row per key and day.

A day keeps, per key, a quantile sketch of each measure and a distinct sketch of
each column. Sketches of any days merge into that of all their readings,
so 7, 30 and 90 days come from one stored table and no reading is read again. Errors don't grow
with the number of days:

* quantiles (KLL, ``k`` = 200): the rank of an estimate is within 1.65 % of the wanted one at 99 % confidence;
* distinct counts (HyperLogLog, 2^``lg_k`` = 4,096 registers): a standard error of 1.04 / sqrt(4096) = 1.63 %.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.plans.gold import with_date
from gaugeflow.runtime import written
from gaugeflow.sources import staging
from gaugeflow.spec import ROLES, Roles, since_days

DAY = "observation_date"
RANK_ERROR = 0.0165  # for K
DISTINCT_ERROR = 0.01625  # for LG_K, one standard deviation
K, LG_K = 200, 12


def daily_sketches(rows: DataFrame, measures: Sequence[str], distinct: Sequence[str] = (), r: Roles = ROLES) -> DataFrame:
    """One row per key and day: ``<measure>_kll``, ``<column>_hll`` and the number of readings. NULLs enter no sketch."""
    parts = [F.kll_sketch_agg_double(F.col(m).cast("double"), K).alias(f"{m}_kll") for m in measures]
    parts += [F.hll_sketch_agg(F.col(c).cast("string"), LG_K).alias(f"{c}_hll") for c in distinct]
    return with_date(rows, r=r).groupBy(r.key, DAY).agg(F.count(F.lit(1)).alias("readings"), *parts)


def store(rows: DataFrame, path: str, measures: Sequence[str], distinct: Sequence[str] = (), r: Roles = ROLES) -> None:
    """Write the sketches of all days that ``rows`` has, whole days each; other days stay."""
    staging.replace(written(daily_sketches(rows, measures, distinct, r), "sketches"), path, [DAY], whole=False)


def look_back(
    sketches: DataFrame, days: int, as_of, keys: Sequence[str], quantiles: Mapping[str, tuple[str, float]], distinct: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per group of ``keys`` over the last ``days`` days: ``readings``, and per name a quantile of a measure or a distinct count.

    ``quantiles`` maps a name to (measure, share), ``distinct`` a name to a column.
    A group without a value of a measure has NULL for it.
    """
    measures = sorted({m for m, _ in quantiles.values()})
    columns = sorted(set((distinct or {}).values()))
    merged = since_days(sketches, days, as_of, DAY).groupBy(*keys).agg(
        F.sum("readings").alias("readings"),
        *[F.kll_merge_agg_double(f"{m}_kll", K).alias(f"_{m}_kll") for m in measures],
        *[F.hll_union_agg(f"{c}_hll").alias(f"_{c}_hll") for c in columns],
    )
    value = lambda m, p: F.when(F.kll_sketch_get_n_double(f"_{m}_kll") > 0, F.kll_sketch_get_quantile_double(f"_{m}_kll", F.lit(float(p))))
    return merged.select(
        *keys, "readings",
        *[value(m, p).alias(n) for n, (m, p) in quantiles.items()],
        *[F.hll_sketch_estimate(f"_{c}_hll").alias(n) for n, c in (distinct or {}).items()],
    )
