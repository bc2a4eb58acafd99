"""Which files of a table may hold a key: a zone map and a Bloom filter per file, kept beside the table.

    <parent>/_index/<table>/<column>/zones    file, rows, smallest and greatest value, number of blocks
    <parent>/_index/<table>/<column>/blocks   file, block, 64 bits

A filter is cut into blocks of one word; a value sets ``PROBES`` bits of one block.
Blocks are rows, so filters are built by a grouping, and looked up by a join of the
values' blocks with those stored, whatever the number of files or of values: no filter is held whole anywhere. A
file's filter has about ``BITS`` bits a row, so some 1.5 % of the files whose span holds a value are
opened in vain. Files are never changed, so an entry stays right; those of new files are added
by reading these alone, those of files that are gone are passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.runtime import delete, written
from gaugeflow.sources import staging
from gaugeflow.sources.layout import files_of

PROBES, BITS = 4, 12
AT_ONCE = 1000  # files indexed in one go


def _home(spark: SparkSession, path: str, column: str) -> str:
    at = staging._path(spark, path)
    return f"{at.getParent()}/_index/{at.getName()}/{column}"


def _hash(column: str) -> Column:
    return F.xxhash64(F.col(column).cast("string"))


def _mask(h: Column) -> Column:
    """The bits that a value sets within its block: other bits of the hash than those that choose the block."""
    out = F.lit(0).cast("bigint")
    for i in range(PROBES):
        at = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
    return out


def _block(h: Column, blocks: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 6 * PROBES), blocks)


def _present(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(staging.literal(path)) if staging.exists(spark, f"{path}/_SUCCESS") else None


def refresh(spark: SparkSession, path: str, column: str) -> int:
    """Index the files of a table that the index lacks; how many these were."""
    home = _home(spark, path, column)
    zones = _present(spark, f"{home}/zones")
    files = files_of(spark, path).select("path")
    new = files if zones is None else files.join(zones.select("path"), "path", "left_anti")
    done, held = 0, []
    for row in written(new, "files").toLocalIterator():
        held.append(row["path"])
        if len(held) == AT_ONCE:
            done += _add(spark, path, column, held, home)
            held = []
    return done + (_add(spark, path, column, held, home) if held else 0)


def _add(spark: SparkSession, path: str, column: str, files: list[str], home: str) -> int:
    """Blocks first, zones last: a file counts as indexed from its zone on."""
    names = spark.createDataFrame([(staging.uri(spark, f), f) for f in files], "_uri string, path string")
    rows = spark.read.option("basePath", path).parquet(*[staging.literal(f) for f in files])
    values = rows.select(F.col(column).alias("value"), F.col("_metadata.file_path").alias("_uri"))
    spans = values.groupBy("_uri").agg(F.count("value").alias("rows"), F.min("value").alias("least"), F.max("value").alias("most"))
    spans = names.join(spans, "_uri", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))
    size = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.lit(1), F.col("rows") * BITS / 64)))).cast("bigint")
    spans = written(spans.withColumn("blocks", size), "zones")
    hashed = values.where("value IS NOT NULL").withColumn("h", _hash("value")).join(F.broadcast(spans.select("_uri", "path", "blocks")), "_uri")
    bits = hashed.groupBy("path", _block(F.col("h"), F.col("blocks")).alias("block")).agg(F.bit_or(_mask(F.col("h"))).alias("bits"))
    bits.repartitionByRange("block").sortWithinPartitions("block").write.mode("append").parquet(f"{home}/blocks")
    spans.drop("_uri").write.mode("append").parquet(f"{home}/zones")
    return len(files)


def files_for(spark: SparkSession, path: str, column: str, values: DataFrame) -> list[str]:
    """The files that may hold one of some values (a column named like ``column``); none that holds one is left out.

    NULL is no value. The index has to be fresh.
    """
    home = _home(spark, path, column)
    zones = spark.read.parquet(staging.literal(f"{home}/zones")).join(files_of(spark, path).select("path"), "path", "left_semi")
    zones = written(zones.dropDuplicates(["path"]).where("rows > 0"), "zones")
    asked = values.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct().withColumn("h", _hash("value"))
    sizes = [r["blocks"] for r in zones.select("blocks").distinct().collect()]  # powers of two: some dozens at most
    if not sizes:
        return []
    asked = written(asked.withColumn("blocks", F.explode(F.array(*[F.lit(n).cast("bigint") for n in sizes]))), "asked")
    probes = asked.select("value", "blocks", _block(F.col("h"), F.col("blocks")).alias("block"), _mask(F.col("h")).alias("mask"))
    held = spark.read.parquet(staging.literal(f"{home}/blocks")).join(zones, "path")
    met = held.join(probes, ["blocks", "block"]).where(
        (F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")) & F.col("value").between(F.col("least"), F.col("most"))
    )
    return [r["path"] for r in met.select("path").distinct().collect()]


def drop(spark: SparkSession, path: str, column: str) -> None:
    delete(spark, _home(spark, path, column))
