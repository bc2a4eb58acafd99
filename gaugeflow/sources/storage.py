"""Writing and maintaining partitioned parquet tables.

Parquet has no MERGE, and overwriting a folder in place loses it if the job dies.
Whatever replaces data goes through ``staging``: written whole beside the table,
committed at once, then put in place by its writer or the next one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.operators.grouping import latest_per
from gaugeflow.runtime import delete, written
from gaugeflow.sources import fileindex, layout, staging
from gaugeflow.sources.schemas import TABLES


def read_if_present(spark: SparkSession, path: str, schema=None, merge: bool = True) -> DataFrame | None:
    """The table at ``path`` as last committed, None if there is none. Nothing is changed or deleted.

    With ``merge`` it has the columns of all its files, which costs a job over
    their footers; a known ``schema`` saves that. A folder without any file is an
    error unless the schema is known: it may be a table that was lost.
    """
    return staging.read(spark, path, schema, merge)


def create_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """An empty table of a known schema, unless it exists; then the table."""
    layout = TABLES[name]
    found = read_if_present(spark, path, layout.stored)
    if found is not None:
        return found
    with staging.writing(spark, path):
        if not staging.exists(spark, path):
            staging.save(spark.createDataFrame([], layout.stored), path, "errorifexists", layout.partition_by)
    return read_if_present(spark, path, layout.stored)


def append(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), derived: Mapping[str, Column] | None = None, order: Sequence[str] = ()
) -> None:
    """Add rows; new columns widen the table.

    Partition columns that are functions of others are ``derived``; with ``order``, the rows of each file are sorted by it.
    """
    with staging.writing(df.sparkSession, path):
        staging.save(df.withColumns(dict(derived)) if derived else df, path, "append", partition_by, order=order)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the table. The input may read the table."""
    staging.replace(df, path, partition_by)


def insert_new(source: DataFrame, path: str, key: str, partition_by: Sequence[str] = (), indexed: bool = False) -> None:
    """Append the rows whose key the table lacks. A repeated load adds nothing.

    ``indexed`` keeps a zone map and a Bloom filter per file and opens only files that may hold a key of the load.

    The keys already present are found from the side of the table, by a semi
    join with the source: a load small enough to be broadcast then costs a scan
    of the key column and no shuffle of the table. Rows with a NULL key are told apart
    by all columns that can be compared and are added once.
    """
    spark = source.sparkSession
    with staging.writing(spark, path):
        source = written(_once(source, F.col(key).isNotNull()), "source")
        target = read_if_present(spark, path, merge=False)  # the key is in all files
        if target is not None:
            there = _holding(spark, path, key, source, target) if indexed else target
            known = there.select(key).join(source.select(key), key, "left_semi").distinct()
            fresh = source.filter(F.col(key).isNotNull()).join(known, key, "left_anti")
            loose = source.filter(F.col(key).isNull())
            if loose.limit(1).count():
                target = read_if_present(spark, path)
                loose = _lacking(loose, target.filter(F.col(key).isNull()))
            source = fresh.unionByName(loose)
        append(source, path, partition_by)


def _holding(spark: SparkSession, path: str, key: str, source: DataFrame, target: DataFrame) -> DataFrame:
    """The files of a table that may hold a key of the source."""
    fileindex.refresh(spark, path, key)
    files = fileindex.files_for(spark, path, key, source)
    if not files:
        return target.limit(0)
    return spark.read.schema(target.schema).option("basePath", path).parquet(*[staging.literal(f) for f in files])


def _comparable(rows: DataFrame) -> list[str]:
    return [f.name for f in rows.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def _lacking(rows: DataFrame, target: DataFrame) -> DataFrame:
    """The rows that the target has no equal of; a column that the target lacks is NULL there."""
    names = _comparable(rows)
    there = target.select(*[(F.col(c).cast(rows.schema[c].dataType) if c in target.columns else F.lit(None)).alias(f"_t_{c}") for c in names])
    return rows.join(there, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in names], "left_anti")


def upsert(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    newest: Sequence[str] = (),
    schema=None,
    derived: Mapping[str, Column] | None = None,
) -> None:
    """Replace rows of equal key, add the others.

    With ``newest``, of two rows of a key the one greater by these columns
    stays, whichever side it comes from; otherwise the source wins. The source
    must not hold a complete key twice. A row with a NULL in its key replaces
    nothing and is kept once, so a repeated load changes nothing. ``schema`` is
    that of the table, if known; otherwise the columns of its files are merged.

    Only partitions that the source touches are read and written. Partition
    columns must be part of the key or, as ``derived``, functions of it (the date of
    its time): both sides of a match then stand in the same partition.
    """
    derived = dict(derived or {})
    if not set(partition_by) <= set(keys) | set(derived):
        raise ValueError("partition columns must be part of the key or derived from it")
    spark = source.sparkSession
    source = written(source.withColumns(derived) if derived else source, "source")
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if source.filter(complete).groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise ValueError(f"source holds several rows for the same {list(keys)}")
    with staging.writing(spark, path):
        target = read_if_present(spark, path, schema)
        if target is None:
            staging.replace(_once(source, complete), path, partition_by)
            return
        if partition_by:
            target = _touched(target, source, partition_by)
        if newest:
            both = target.unionByName(source, allowMissingColumns=True)
            merged = latest_per(both.filter(complete), keys, *newest).unionByName(both.filter(~complete))
        else:
            kept = target.join(source.filter(complete).select(*keys), list(keys), "left_anti")
            merged = kept.unionByName(source, allowMissingColumns=True)
        staging.replace(_once(merged, complete), path, partition_by, whole=not partition_by)


def _once(rows: DataFrame, complete: Column) -> DataFrame:
    """Rows without a complete key once each; they are told apart by all columns that can be compared."""
    return rows.filter(complete).unionByName(rows.filter(~complete).dropDuplicates(_comparable(rows)))


def _touched(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of the target in partitions that the source has rows for.

    A semi join selects them. The scan leaves out folders beyond the smallest and
    the greatest value of each column in the source, whatever their number: one row
    tells them.
    """
    names = [F.col(p) for p in partition_by]
    spans = source.agg(*[f(p).alias(f"{n}{i}") for i, p in enumerate(names) for f, n in ((F.min, "lo"), (F.max, "hi"))],
                       *[F.count(F.when(p.isNull(), 1)).alias(f"no{i}") for i, p in enumerate(names)]).first()
    for i, p in enumerate(partition_by):
        kind = source.schema[p].dataType
        within = F.col(p).between(F.lit(spans[f"lo{i}"]).cast(kind), F.lit(spans[f"hi{i}"]).cast(kind))
        target = target.filter(within | F.col(p).isNull() if spans[f"no{i}"] else within)
    seen = source.select(*[F.col(p).alias(f"_t_{p}") for p in partition_by]).distinct()
    return target.join(seen, [F.col(p).eqNullSafe(F.col(f"_t_{p}")) for p in partition_by], "left_semi")


def write_gold(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), derived: Mapping[str, Column] | None = None
) -> str:
    """Upsert by (city, date) or (city, time), whichever the table has; append otherwise.

    An empty input writes nothing. Returns what was done.
    """
    if df.limit(1).count() == 0:
        return "skipped"
    for keys in (["city", "observation_date"], ["city", "observation_time"]):
        if set(keys) <= set(df.columns):
            upsert(df, path, keys, partition_by, derived=derived)
            return "upserted on " + ", ".join(keys)
    append(df, path, partition_by)
    return "appended"


def materialise(
    df: DataFrame,
    name: str,
    kind: str = "view",
    path: str | None = None,
    unique_key: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Keep a model as a view, a table, or an incrementally merged table, and register it."""
    spark = df.sparkSession
    if kind == "table":
        overwrite(df, path, partition_by)
    elif kind == "incremental":
        upsert(df, path, unique_key, partition_by)
    elif kind != "view":
        raise ValueError(f"unknown materialisation {kind!r}")
    out = df if kind == "view" else read_if_present(spark, path)
    out.createOrReplaceTempView(name)
    return out


def compact(spark: SparkSession, path: str, target: str, cluster_by: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Rewrite a dataset clustered by several columns, so that file statistics skip for a filter on any of them."""
    layout.cluster(spark, path, cluster_by, partition_by, target)


def dataset_profile(df: DataFrame) -> DataFrame:
    """Bytes, files and rows of a file-based dataset."""
    per_file = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    )
    return (
        per_file.groupBy("path")
        .agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("rows"))
        .agg(
            F.coalesce(F.sum("size"), F.lit(0)).alias("size_bytes"),
            F.count(F.lit(1)).alias("num_files"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("num_records"),
        )
    )


def apply_retention(spark: SparkSession, path: str, column: str, days: int, as_of, partition_by: Sequence[str] = ()) -> None:
    """Keep only the last ``days`` days of a table.

    Where the table is partitioned, folders without a row to drop stay as they are.
    """
    from gaugeflow.sources.raw import retained

    with staging.writing(spark, path):
        table = read_if_present(spark, path)
        kept = retained(table, days, as_of, column)
        if not partition_by:
            overwrite(kept, path)
            return
        # per folder: rows, and rows that stay
        of = lambda df, n: df.groupBy(*[F.col(p).alias(f"{n}_{p}") for p in partition_by]).agg(F.count(F.lit(1)).alias(n))
        same = [F.col(f"a_{p}").eqNullSafe(F.col(f"b_{p}")) for p in partition_by]
        folders = written(of(table, "a").join(of(kept, "b"), same, "left").select(*[F.col(f"a_{p}").alias(p) for p in partition_by], "a", "b"))
        mixed = folders.filter("b < a")
        if mixed.limit(1).count():
            staging.replace(_touched(kept, mixed, partition_by), path, partition_by, whole=False)
        for row in folders.filter("b IS NULL").select(*partition_by).toLocalIterator():  # a folder each, one at a time
            delete(spark, path.rstrip("/") + "".join(f"/{p}={_folder(spark, row[p])}" for p in partition_by))


def _folder(spark: SparkSession, value) -> str:
    """A partition value as part of a path."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


def flat_tags(metrics: DataFrame, tags: Sequence[str] | None = None) -> DataFrame:
    """Metric rows with one column per named tag; without names, all tags as one JSON text."""
    if tags is None:
        return metrics.withColumn("tags", F.to_json("tags"))
    rest = [c for c in metrics.columns if c != "tags"]
    return metrics.select(*rest, *[F.try_element_at("tags", F.lit(t)).alias(t) for t in tags])


# microseconds are kept
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def export_metrics(metrics: DataFrame, path: str, format: str = "json", tags: Sequence[str] | None = None) -> None:
    """Write metric rows as JSON lines, or as CSV with tags as columns."""
    if format == "json":
        metrics.write.mode("overwrite").json(path)
    elif format == "csv":
        flat = flat_tags(metrics, tags)
        flat.write.mode("overwrite").options(header="true", **CSV_TIMES).csv(path)
    else:
        raise ValueError(f"unsupported export format: {format}")


def query(spark: SparkSession, text: str, tables: dict[str, DataFrame], **args) -> DataFrame:
    """SQL over named tables with bound parameters (``:name``)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args or None)


