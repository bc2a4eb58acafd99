"""A history of versions that is kept over loads: closed spans by day of their end, open ones apart.

The table is partitioned by ``closed_on``, the day a version stopped being
current, NULL for the open ones. A load reads the open versions; those of its keys
are closed at the first newer version and opened again at the last. Only where a
version arrives late, older than the open one of its key, are closed days read: those
from its own day on, the only ones that can hold a span it cuts. Days that no
span enters or leaves are not written. Loads in any split and order, repeated ones
included, give the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.operators.grouping import latest_per
from gaugeflow.operators.ordered import group_size, neighbour
from gaugeflow.runtime import written
from gaugeflow.sources import staging
from gaugeflow.sources.storage import _touched

PART = "closed_on"
EVER = "0001-01-01"


def _schema(load: DataFrame, updated: str) -> T.StructType:
    kind = load.schema[updated].dataType
    added = [T.StructField("valid_from", kind), T.StructField("valid_to", kind), T.StructField(PART, T.DateType())]
    return T.StructType([*load.schema.fields, *added])


def _start(day: Column, grain: str) -> Column:
    return F.trunc(day.cast("date"), grain) if grain != "day" else day.cast("date")


def _chained(versions: DataFrame, keys: Sequence[str], updated: str, grain: str) -> DataFrame:
    """Versions, one for each key and time, with the span they are current."""
    ended = neighbour(versions, keys, [updated], {"valid_to": updated}, ahead=True, size=group_size(versions, keys))
    return ended.select(
        *versions.columns, F.col(updated).alias("valid_from"), "valid_to", _start(F.col("valid_to"), grain).alias(PART)
    )


def _same(prefix: str, columns: Sequence[str]) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns]


def _named(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in columns])


def read(spark: SparkSession, path: str, like: DataFrame, updated: str) -> DataFrame | None:
    """The history at ``path`` of versions with the columns of ``like``, None if there is none."""
    return staging.read(spark, path, _schema(like, updated))


def keep_history(load: DataFrame, path: str, keys: Sequence[str], updated: str, grain: str = "day") -> None:
    """Add a load of versions to the history at ``path``.

    Of several versions of a key with the same time the greatest by the other columns
    stays. A NULL in a key is a key like others; a version without a time is
    the oldest. The columns of the first load are those of the table. ``grain``
    (day, month, year) is what closed spans are parted by; it stays with the table.
    """
    spark, schema = load.sparkSession, _schema(load, updated)
    rest = [c for c in load.columns if c not in (*keys, updated)]
    load = written(latest_per(load, [*keys, updated], *rest), "versions")
    with staging.writing(spark, path):
        table = staging.read(spark, path, schema)
        if table is None:
            staging.replace(_chained(load, keys, updated, grain), path, [PART])
            return
        mine = _affected(table, load, keys, updated, grain)
        versions = mine.select(*load.columns).unionByName(load)
        new = written(_chained(latest_per(versions, [*keys, updated], *rest), keys, updated, grain), "spans")
        parts = mine.select(PART).unionByName(new.select(PART)).distinct()
        kept = _touched(table, written(parts, "days"), [PART])
        gone = _named(mine, "_m_", [*keys, updated])
        kept = kept.join(gone, _same("_m_", [*keys, updated]), "left_anti")
        staging.replace(kept.unionByName(new), path, [PART], whole=False)


def _affected(table: DataFrame, load: DataFrame, keys: Sequence[str], updated: str, grain: str) -> DataFrame:
    """The stored versions whose spans a load may change."""
    first = load.groupBy(*keys).agg(F.min(updated).alias("_first"), F.count_if(F.col(updated).isNull()).alias("_bare"))
    side = first.select(*[F.col(k).alias(f"_f_{k}") for k in keys], "_first", "_bare")
    now = table.filter(F.col(PART).isNull())
    found = written(now.join(side, _same("_f_", keys)), "open")
    back = F.when(F.col("_bare") > 0, F.lit(EVER).cast("date")).otherwise(_start(F.col("_first"), grain))
    late = found.filter((F.col("_bare") > 0) | (F.col("_first") <= F.col(updated)) | F.col(updated).isNull())
    late = late.select(*[F.col(f"_f_{k}") for k in keys], back.alias("_back"))
    day = late.agg(F.min("_back")).first()[0]
    mine = found.select(*table.columns)
    if day is None:
        return mine
    closed = table.filter(F.col(PART) >= F.lit(day.isoformat()).cast("date"))  # folders before it are not listed
    cut = closed.join(late, [*_same("_f_", keys), F.col(PART) >= F.col("_back")]).select(*table.columns)
    return written(mine.unionByName(cut), "affected")
