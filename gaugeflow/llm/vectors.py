"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import name, stored


def usable(column: str) -> Column:
    """Not null, not zero, and every component there and finite."""
    v = name(column)
    big = F.lit(float("inf")).cast("double")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < big))
    return v.isNotNull() & F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column whose lists all have ``dim`` numbers, in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, k = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k), pa.int32()), pa.array(rows.ravel(), kind))


def ranked(df: DataFrame, order: list[str], out: str, label: str) -> DataFrame:
    """Add ``out``: the place of a row, from 0, in the order of columns that tell all rows apart.

    A range partitioning, sorted and written once; its parts are numbered by
    themselves and get the number of rows before them, one row per part.
    """
    own = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    cut = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    cut, _ = stored(cut.withColumns({"__part": F.spark_partition_id(), "__own": own}), label)
    sizes = cut.groupBy("__part").count()
    before = F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    return cut.join(offsets, "__part").withColumn(out, F.col("__before") + F.col("__own")).drop("__part", "__own", "__before")
