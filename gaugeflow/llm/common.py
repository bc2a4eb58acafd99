"""Words, stored tables, connected components and running sums that the operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.runtime import scratch_path

# Fixed value: what separates words, in every operator that counts or compares words.
SPACE = "[\\x20\\x09-\\x0D]+"
CHUNK = 1 << 20
_SPACE_BYTE = re.compile(rb"[\x20\x09-\x0D]")


def word_array(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_chunks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about a megabyte at a time: memory doesn't grow with its length."""
    at = 0
    while at < len(data):
        cut = _SPACE_BYTE.search(data, at + CHUNK)
        end = cut.start() if cut else len(data)
        if words := data[at:end].split():
            yield words
        at = end


def name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back; also its path, for ``forget``."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _stars(edges: DataFrame) -> DataFrame:
    """A large-star step and a small-star step over edges (hi, lo), lo < hi.

    The least neighbour comes from a grouped minimum, which is partly formed
    before the shuffle, and goes back by a join, whose hot keys adaptive
    execution splits: no task holds all neighbours of a node.
    """
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    large = (
        both.join(least, "u").where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
        .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    )
    root = large.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = large.join(root, "hi")
    return (
        moved.where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        .unionAll(moved.select("hi", F.col("m").alias("lo")))
        .distinct()
    )


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of undirected links (a, b): (node, root), root the smallest node reachable.

    Only nodes with a link to another node appear. Alternating large-star and
    small-star steps, each written to the shared folder, until the edges stay
    as they are; a component then is a star around its smallest node. Links
    that hold a null or the same node twice are left out.
    """
    spark = links.sparkSession
    first = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges, path = stored(first.where("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct(), label)
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if now == seen or now[0] == 0:
            break
        seen, old = now, path
        edges, path = stored(_stars(edges), label)
        forget(spark, old)
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


def running_sum(df: DataFrame, by: list[str], index: str, value: str, out: str, step: int = 4096) -> DataFrame:
    """Add ``out``: the sum of ``value`` over smaller ``index`` in the same group.

    ``index`` is a whole number that grows densely. The sum is formed in two levels,
    so that a task holds ``step`` indexes of a group, or one row per ``step`` of them.
    """
    part = F.floor(F.col(index) / F.lit(step)).cast("bigint")
    cut = df.withColumn("__part", part)
    inner = Window.partitionBy(*by, "__part").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*by, "__part").agg(F.sum(value).alias("__sum"))
    before = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(outer), F.lit(0))).drop("__sum")
    mine = cut.withColumn("__inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    on = [mine[c].eqNullSafe(before[c]) for c in [*by, "__part"]]
    joined = mine.join(before, on)
    return joined.select(
        *[mine[c] for c in df.columns], (F.col("__inner") + F.col("__before")).cast("bigint").alias(out)
    )
