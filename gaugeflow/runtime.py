"""Session defaults, size limits and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

# A group with more rows than this is never handed to a single task.
MAX_GROUP_ROWS = ("spark.gaugeflow.maxGroupRows", 2_000_000)
# Sliding time frames are re-evaluated per row; where a key has more rows than
# this in the length of a frame, a linear method takes over.
MAX_FRAME_ROWS = ("spark.gaugeflow.maxFrameRows", 500)
# What a task sorts at once to write one file, in bytes of memory: rows take some ten times that of their parquet files.
MAX_SORT_BYTES = ("spark.gaugeflow.maxSortBytes", 256 << 20)
_scratch: dict[str, str] = {}


def session(app: str = "gaugeflow", master: str | None = None, partitions: int | None = None, **conf) -> SparkSession:
    """A session with the settings the library is written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # plans are built from many small columns; do not trace each of them
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), str(value))
    return builder.getOrCreate()


def limit(spark: SparkSession, setting: tuple[str, int]) -> int:
    name, default = setting
    return int(spark.conf.get(name, str(default)))


def scratch_dir(spark: SparkSession) -> str:
    """The session's folder for intermediate tables, which all executors share.

    It stands in the folder of ``spark.checkpoint.dir``; without that setting, in
    the warehouse. It is deleted when the program ends.
    """
    app = spark.conf.get("spark.app.id", "local")
    if app not in _scratch:
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        _scratch[app] = f"{shared.rstrip('/')}/gaugeflow-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_clear, spark, _scratch[app])
    return _scratch[app]


def _clear(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone; the folder then is left to expire
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it exists."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage on reliable storage, pins non-repeatable splits, and gives
    the optimizer the true size of the data: it then broadcasts the table only
    if it is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans
    a sort-merge join, whose hot partitions adaptive execution splits.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
