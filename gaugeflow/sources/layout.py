"""How the rows of a table lie in its files: clustering by several columns, and packing of small files.

A linear sort by (a, b) gives files narrow spans of ``a`` and the whole span of ``b``.
``cluster`` sorts by a space-filling curve instead. Each column is ranked against
quantiles of itself, so skewed values spread over all ranks, and the bits of
the ranks are interleaved: with k columns, the spans of each shrink by about the k-th
root of the number of files, and a filter on any of them skips files. A file is sorted by
one task: there are as many as hold the rows of each to ``spark.gaugeflow.maxSortBytes``
in memory, however well they compress.

``pack`` writes the small files of each folder again as few of about the target size.
Larger files keep their path and bytes. It goes on until no two small files would
fit together, so repeating it changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.runtime import MAX_SORT_BYTES, limit, written
from gaugeflow.sources import staging

BITS = 8  # of a rank
SAMPLE = 64  # sampled rows for each rank
FILE_BYTES = 256 << 20
SORTED_ROW = 64  # bytes of a row in a sort besides its columns: pointers, prefixes, lengths


def _quantiles(df: DataFrame, columns: Sequence[str], bits: int, rows: int) -> dict[str, list]:
    """Per column up to 2^bits - 1 values that cut it into even parts, from one bounded sample of rows."""
    some = df.select(*columns).sample(min(1.0, (SAMPLE << bits) / max(rows, 1)), seed=7).collect()
    found = {}
    for c in columns:
        values = sorted(v for r in some if (v := r[c]) is not None)
        cuts = [values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)] if values else []
        found[c] = sorted(set(cuts))
    return found


def rank(value: Column, cuts: Sequence, kind: T.DataType, bits: int = BITS) -> Column:
    """How many of the sorted ``cuts`` are not greater than a value, by halving; 0 for NULL."""
    if not cuts:
        return F.lit(0).cast("bigint")
    table = F.array(*[F.lit(c).cast(kind) for c in cuts])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    step = lambda at, s: F.when(F.coalesce(F.get(table, at + s - 1) <= value, F.lit(False)), at + s).otherwise(at)
    return F.coalesce(F.aggregate(steps, F.lit(0), step), F.lit(0)).cast("bigint")


def curve(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The place on the space-filling curve: the bits of all ranks in turn, the highest first."""
    out = F.lit(0).cast("bigint")
    for b in range(bits):
        for j, r in enumerate(ranks):
            bit = F.shiftright(r, b).bitwiseAND(F.lit(1).cast("bigint"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(ranks) + len(ranks) - 1 - j))
    return out


def _in_memory(df: DataFrame) -> tuple[int, int]:
    """Rows, and about the bytes that sorting them takes: eight per column, and the lengths of texts and nested values."""
    texts = [F.col(f.name) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [F.to_json(f.name) for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
    width = sum([F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in texts + nested], F.lit(SORTED_ROW + 8 * len(df.columns)).cast("bigint"))
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first())


def clustered(df: DataFrame, by: Sequence[str], files: int, partition_by: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """``df`` in ``files`` parts along the curve of ``by``, within each value of ``partition_by``; in more where a task could not sort one.

    Equal rows of the columns may be many: a hash of the row cuts them further, and the place of a copy cuts copies.
    """
    by = [c for c in by if c not in partition_by]
    bits = min(bits, 62 // max(len(by), 1))
    rows, held = _in_memory(df)
    files = max(files, -(-held // limit(df.sparkSession, MAX_SORT_BYTES)))
    cuts = _quantiles(df, by, bits, rows) if by else {}
    place = curve([rank(F.col(c), cuts[c], df.schema[c].dataType, bits) for c in by], bits)
    hashed = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [*partition_by, "_curve", *by, "_row", "_copy"]
    placed = df.withColumns({"_curve": place, "_row": F.xxhash64(*hashed), "_copy": F.monotonically_increasing_id()})
    return placed.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_curve", "_row", "_copy")


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """(path, folder, length) of the data files of a table; no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return listed.load(staging.literal(path)).select(
        "path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), "length"
    )


def cluster(
    spark: SparkSession, path: str, by: Sequence[str], partition_by: Sequence[str] = (), target: str | None = None,
    file_bytes: int = FILE_BYTES, bits: int = BITS,
) -> None:
    """Rewrite a table along the curve of ``by``, in place or to ``target``, in files of about ``file_bytes``, or less by ``clustered``."""
    to = target or path
    with staging.writing(spark, to) as lease:
        size = files_of(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        df = clustered(staging.read(spark, path), by, max(1, -(-size // file_bytes)), partition_by, bits)
        content = staging.content_path(spark, to)
        writer = df.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(content)
        staging.commit(spark, to, staging.Ready(content, "table"), lease)


def _bins(spark: SparkSession, path: str, target: int, small: int) -> DataFrame:
    """(bin, path) of small files that are to become one file: those of a folder, laid end to end, cut at multiples of ``target``."""
    files = files_of(spark, path).where(F.col("length") < small)
    files.createOrReplaceTempView("_gaugeflow_files")
    laid = spark.sql(
        "SELECT path, folder, coalesce(sum(length) OVER (PARTITION BY folder ORDER BY length DESC, path "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) DIV {target} AS cut FROM _gaugeflow_files"
    )
    spark.catalog.dropTempView("_gaugeflow_files")
    return laid.groupBy("folder", "cut").agg(F.collect_list("path").alias("paths")).where(F.size("paths") > 1)


def pack(
    spark: SparkSession, path: str, partition_by: Sequence[str] = (), target: int = FILE_BYTES, small: float = 0.5, at_once: int = 1000,
) -> int:
    """Write small files of each folder again as files of about ``target`` bytes; how many files went.

    Small is under ``small * target``. Files are taken some ``at_once`` at a time, each time one
    commit: a job that dies leaves a table that is whole, with fewer small files.
    """
    gone = 0
    with staging.writing(spark, path) as lease:
        schema = staging.read(spark, path).schema  # of all files
        while True:
            bins = written(_bins(spark, path, target, int(small * target)), "bins")
            found, held = False, []
            for row in bins.toLocalIterator():
                found = True
                held.append(row["paths"])
                if sum(map(len, held)) >= at_once:
                    gone += _pack(spark, path, schema, partition_by, held, lease)
                    held = []
            if held:
                gone += _pack(spark, path, schema, partition_by, held, lease)
            if not found:
                return gone


def _pack(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], bins: list[list[str]], lease: staging.Lease
) -> int:
    """One commit: a new file for each bin, its old files go."""
    old = [p for b in bins for p in b]
    at = spark.createDataFrame([(staging.uri(spark, p), i) for i, b in enumerate(bins) for p in b], "_path string, _bin int")
    rows = spark.read.schema(schema).option("basePath", path).parquet(*[staging.literal(p) for p in old])
    rows = rows.withColumn("_file", F.col("_metadata.file_path"))
    rows = rows.join(F.broadcast(at), F.col("_file") == F.col("_path"))  # some ``at_once`` rows, a bin at most over that
    rows = rows.repartitionById(len(bins), "_bin").drop("_file", "_path", "_bin")
    content = staging.content_path(spark, path)
    writer = rows.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(content)
    staging.commit(spark, path, staging.Ready(content, "files", tuple(partition_by), tuple(old)), lease)
    return len(old)


def spans(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per file of a table, smallest and greatest value of some columns and its rows: what a filter may skip."""
    ends = [f(c).alias(f"{n}_{c}") for c in columns for f, n in ((F.min, "min"), (F.max, "max"))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)
