"""Replacing what a table holds: safe against writers that die, other writers, and readers.

Parquet has no transactions, so new content is written whole beside the table, in

    <parent>/_staged/<table>/content-<id>

a folder of exactly this table: ``_staged`` is reserved, no table may be named so, and Spark's
readers skip it. The file ``ready`` in it, put there by one rename, is the commit. It
names the content and how it takes effect:

* ``table``: it replaces the table, by a rename;
* ``partitions``: it replaces the partitions that it has rows for, by an overwrite that may be repeated;
* ``files``: its files join the table and the files listed go.

A writer holds the table's ``lease``, a file that names it and whose time it keeps
renewing. Who gets the lease first finishes a replacement that is ready and deletes
content that isn't: its writer is dead, or it would hold the lease. A lease not
renewed for ``spark.gaugeflow.leaseSeconds`` may be taken over; its former holder finds
out before it commits. Readers change nothing: where a replacement is ready, and not in place yet,
they read the content in place of what it replaces.

This needs a file system on which creating a file that exists fails and a rename
is atomic (HDFS, local disks).
"""

from __future__ import annotations

import contextlib
import json
import threading
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.runtime import delete

RESERVED = "_staged"
LEASE_SECONDS = ("spark.gaugeflow.leaseSeconds", "60")
_held: dict[tuple[str, int], Lease] = {}


class TableBusy(RuntimeError):
    """Another writer holds the table, or has taken it over."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def rename(spark: SparkSession, old: str, new: str) -> None:
    if not _fs(spark, old).rename(_path(spark, old), _path(spark, new)):
        raise OSError(f"could not rename {old} to {new}")


def _write(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; an error if it is there."""
    out = _fs(spark, path).create(_path(spark, path), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read(spark: SparkSession, path: str) -> str | None:
    try:
        source = _fs(spark, path).open(_path(spark, path))
    except Exception:  # noqa: BLE001 - the JVM's error for a missing file, or for one that goes just now
        if exists(spark, path):
            raise
        return None
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def literal(path: str) -> str:
    """A path for Spark's readers, which take ``[`` and the like for patterns."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def uri(spark: SparkSession, path: str) -> str:
    """A path as ``_metadata.file_path`` shows it."""
    return _path(spark, path).toUri().toString()


def area(spark: SparkSession, path: str) -> str:
    """The folder for staged content of a table."""
    at = _path(spark, path)
    if at.getParent() is None or RESERVED in (at.getName(), at.getParent().getName()):
        raise ValueError(f"{path} can't be a table")
    return f"{at.getParent()}/{RESERVED}/{at.getName()}"


@dataclass
class Lease:
    """The right to write a table, renewed in the background until it is released."""

    spark: SparkSession
    file: str
    token: str = field(default_factory=lambda: uuid.uuid4().hex)
    ended: threading.Event = field(default_factory=threading.Event)

    def acquire(self, seconds: float, wait: float) -> None:
        until = time.time() + wait
        while True:
            with contextlib.suppress(Exception):
                _write(self.spark, self.file, self.token)
            if _read(self.spark, self.file) == self.token:
                break
            self._take_over(seconds)
            if time.time() > until:
                raise TableBusy(f"another writer holds {self.file}")
            time.sleep(min(1.0, seconds / 4))
        threading.Thread(target=self._renew, args=(seconds / 4,), daemon=True).start()

    def _take_over(self, seconds: float) -> None:
        fs, at = _fs(self.spark, self.file), _path(self.spark, self.file)
        with contextlib.suppress(Exception):  # gone, or taken by somebody else, in between
            if time.time() - fs.getFileStatus(at).getModificationTime() / 1000 > seconds:
                fs.delete(at, False)

    def _renew(self, every: float) -> None:
        while not self.ended.wait(every):
            with contextlib.suppress(Exception):
                _fs(self.spark, self.file).setTimes(_path(self.spark, self.file), int(time.time() * 1000), -1)

    def check(self) -> None:
        if _read(self.spark, self.file) != self.token:
            raise TableBusy(f"{self.file} was taken over")

    def release(self) -> None:
        self.ended.set()
        if _read(self.spark, self.file) == self.token:
            delete(self.spark, self.file)


@dataclass(frozen=True)
class Ready:
    """A replacement that is committed; ``kind`` as above."""

    content: str
    kind: str
    partition_by: tuple[str, ...] = ()
    gone: tuple[str, ...] = ()  # files


def ready(spark: SparkSession, path: str) -> Ready | None:
    """What is committed and not wholly in place."""
    text = _read(spark, f"{area(spark, path)}/ready")
    if text is None:
        return None
    found = json.loads(text)
    return Ready(found["content"], found["kind"], tuple(found["partition_by"]), tuple(found["gone"]))


@contextlib.contextmanager
def writing(spark: SparkSession, path: str, wait: float | None = None) -> Iterator[Lease]:
    """Hold the lease of a table; what a dead writer left is finished or dropped first. May be nested."""
    home = area(spark, path)
    me = (home, threading.get_ident())
    if me in _held:
        yield _held[me]
        return
    seconds = float(spark.conf.get(*LEASE_SECONDS))
    lease = Lease(spark, f"{home}/lease")
    lease.acquire(seconds, 2 * seconds if wait is None else wait)
    _held[me] = lease
    try:
        finish(spark, path)
        for left in _fs(spark, home).listStatus(_path(spark, home)):
            if left.getPath().getName().startswith(("content-", "ready-")):
                delete(spark, left.getPath().toString())
        yield lease
    finally:
        del _held[me]
        lease.release()


def content_path(spark: SparkSession, path: str) -> str:
    return f"{area(spark, path)}/content-{uuid.uuid4().hex}"


def commit(spark: SparkSession, path: str, change: Ready, lease: Lease) -> None:
    """Make written content the table's, and put it in place."""
    lease.check()
    home = area(spark, path)
    draft = f"{home}/ready-{lease.token}"
    _write(spark, draft, json.dumps(asdict(change)))
    rename(spark, draft, f"{home}/ready")
    finish(spark, path)


def finish(spark: SparkSession, path: str) -> None:
    """Put committed content in place; may be repeated after a failure at any point."""
    change = ready(spark, path)
    if change is None:
        return
    if exists(spark, change.content):
        put(spark, path, change)
    delete(spark, f"{area(spark, path)}/ready")


def put(spark: SparkSession, path: str, change: Ready) -> None:
    if change.kind == "table":
        delete(spark, path)
        rename(spark, change.content, path)
        return
    if change.kind == "partitions":
        # content is staged without partition folders, so the columns have kept their types
        save(spark.read.parquet(literal(change.content)), path, "overwrite", change.partition_by, dynamic=True)
    else:
        for file in change.gone:
            delete(spark, file)
        _move(spark, change.content, path)
    delete(spark, change.content)


def _move(spark: SparkSession, content: str, path: str) -> None:
    """Move all data files to the same places under the table; their names are unique."""
    fs, base = _fs(spark, content), _path(spark, content).toUri().getPath()
    files = fs.listFiles(_path(spark, content), True)
    while files.hasNext():
        at = files.next().getPath()
        if at.getName().startswith(("_", ".")):
            continue
        target = _path(spark, path.rstrip("/") + at.toUri().getPath()[len(base) :])
        fs.mkdirs(target.getParent())
        if not fs.rename(at, target):
            raise OSError(f"could not move {at}")


def save(
    df: DataFrame, path: str, mode: str, partition_by: Sequence[str] = (), dynamic: bool = False, order: Sequence[str] = ()
) -> None:
    if partition_by:
        # even files: adaptive execution splits large partitions and joins small ones
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if order:
        # the writer sorts by folder anyway
        df = df.sortWithinPartitions(*partition_by, *order)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), whole: bool = True) -> None:
    """Replace the table, or (not ``whole``) its partitions that ``df`` has rows for. ``df`` may read the table."""
    spark = df.sparkSession
    with writing(spark, path) as lease:
        content = content_path(spark, path)
        save(df, content, "errorifexists", partition_by if whole else ())
        kind = "table" if whole or not partition_by else "partitions"
        commit(spark, path, Ready(content, kind, tuple(partition_by)), lease)


def read(spark: SparkSession, path: str, schema=None, merge: bool = True) -> DataFrame | None:
    """The table as last committed, None if there is none; changes nothing."""
    for last in (False, True):
        try:
            return _as_committed(spark, path, schema, merge)
        except AnalysisException as e:
            # a replacement was put in place in between
            if last or e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    raise AssertionError


def _as_committed(spark: SparkSession, path: str, schema, merge: bool) -> DataFrame | None:
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", str(merge).lower())
    change = ready(spark, path)
    if change and not exists(spark, change.content):
        change = None
    if change and change.kind == "table":
        return reader.parquet(literal(change.content))
    if not exists(spark, path):
        return None
    table = reader.parquet(literal(path))
    if not change:
        return table
    if change.kind == "files":
        return table.where(~F.col("_metadata.file_path").isin([uri(spark, f) for f in change.gone])).unionByName(
            reader.parquet(literal(change.content)), allowMissingColumns=True
        )
    content = spark.read.parquet(literal(change.content))
    parts = content.select(*[F.col(p).cast(table.schema[p].dataType).alias(f"_p_{p}") for p in change.partition_by]).distinct()
    kept = table.join(parts, [F.col(p).eqNullSafe(F.col(f"_p_{p}")) for p in change.partition_by], "left_anti")
    return kept.unionByName(content.withColumns({p: F.col(p).cast(table.schema[p].dataType) for p in change.partition_by}), allowMissingColumns=True)
