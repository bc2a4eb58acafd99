"""Embedding near-duplicates by sorted projection passes.

A pass draws 63 random directions; a vector's signs along them, one after the
other, are its key, and all vectors of a label are ordered by it. Near vectors
share long beginnings of their keys and so stand close together. Each vector is
compared with the next ``window`` in that order. Where more than a window of
vectors share label and the first ``prefix`` bits (a large group of near copies),
all of them are compared with each other: chunk against chunk, each pair of
chunks a group of its own. Pairs are verified by their cosine in double precision.

Pairs don't leave a task. Every vector carries its places in all passes, so a
pair that an earlier pass compares is left to that pass: vectors of a chunk are
split by their beginnings in earlier passes, and only what differs in these is
multiplied. A task returns, per vector, the number of links it found, and a
spanning forest of them. Counts are summed, forests are united over all passes.

Equal vectors of a label are one vector with a multiplicity, however many.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import components, name, stored
from gaugeflow.llm.vectors import lists, matrix, ranked, usable

BITS = 63
FEW = 16  # vectors that aren't worth splitting further


@dataclass(frozen=True)
class Settings:
    passes: int = 16
    window: int = 128
    prefix: int = 16
    unit: int = 2048  # vectors in order that a task compares at a time
    chunk: int = 1024  # the same, of a large group
    seed: int = 4


def _keys(x: np.ndarray, s: Settings) -> np.ndarray:
    """Per vector and pass the signs along the pass's directions, the first one in the highest bit."""
    rng = np.random.default_rng(s.seed)
    out = np.zeros((len(x), s.passes), np.int64)
    for p in range(s.passes):
        signs = x @ rng.standard_normal((x.shape[1], BITS)) > 0
        out[:, p] = signs @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))
    return out


def _projected(reps: DataFrame, s: Settings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                own = b.filter(pa.array(dims == d))
                keys = _keys(matrix(own.column("vec"), int(d)), s)
                yield pa.RecordBatch.from_arrays([own.column("rid"), lists(keys, pa.int64())], ["rid", "keys"])

    keys = reps.select("rid", "vec", "dim").mapInArrow(run, "rid bigint, keys array<bigint>")
    return keys.select("rid", F.posexplode("keys").alias("pass", "key"))


def _links(x: np.ndarray, y: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(x @ y.T >= least)


def _blocks(rows: np.ndarray, cols: np.ndarray, head: np.ndarray, which: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of ``rows`` and ``cols`` that hold each pair without an equal head in the passes before ``which`` once.

    Rows are split by their heads in one earlier pass after the other, down to
    ``FEW``, so some pairs with equal heads are left in for the caller to drop.
    """
    todo = [(rows, cols, 0)]
    while todo:
        r, c, q = todo.pop()
        if not len(c):
            continue
        if q == which or len(r) <= FEW:
            for i in range(0, len(r), most):
                yield r[i : i + most], c
            continue
        mine, theirs = head[r, q], head[c, q]
        for h in np.unique(mine):
            todo.append((r[mine == h], c[theirs != h], q + 1))


class Found:
    """Links of a unit: counts, and which vectors hang together."""

    def __init__(self, n: int) -> None:
        self.n_links, self.root = np.zeros(n, np.int64), np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray, mult: np.ndarray) -> None:
        np.add.at(self.n_links, a, mult[b])
        np.add.at(self.n_links, b, mult[a])
        while True:
            least = np.minimum(self.root[a], self.root[b])
            old = self.root.copy()
            np.minimum.at(self.root, self.root[a], least)
            np.minimum.at(self.root, self.root[b], least)
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]
            if (old == self.root).all():
                return

    def rows(self, rid: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(self.n_links > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(rid[at]), pa.array(self.n_links[at]), pa.array(rid[self.root[at]])], ["rid", "n", "root"]
        )


def _compare(t: pa.Table, which: int, large: bool, apart_chunks: bool, least: float, s: Settings) -> pa.RecordBatch:
    """The links of a unit that no earlier pass compares. ``side``: 0 the unit's own, 1 what they're compared with too."""
    rank = np.stack(t.column("ranks").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, s.passes))
    by = np.argsort(rank[:, which], kind="stable")
    t, rank = t.take(pa.array(by)), rank[by]
    head = t.column("heads").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, s.passes)
    rid, mult = t.column("rid").to_numpy(), t.column("mult").to_numpy()
    group = t.column("grp").to_numpy()
    side = t.column("side").to_numpy()
    found = Found(len(rid))
    dims = t.column("dim").to_numpy()
    for d in np.unique(dims):
        own = np.flatnonzero(dims == d)
        x = matrix(t.column("vec").combine_chunks().take(pa.array(own)), int(d))
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        left = np.flatnonzero(side[own] == 0)
        if large:
            blocks = _blocks(left, np.arange(len(own)), head[own], which, s.window)
        else:
            some = [left[i : i + s.window] for i in range(0, len(left), s.window)]
            last = [np.searchsorted(rank[own, which], rank[own[r[-1]], which] + s.window, "right") for r in some]
            blocks = ((r, np.arange(r[0], hi)) for r, hi in zip(some, last, strict=True))
        for some, others in blocks:
            a, b = _links(x[some], x[others], least)
            a, b = own[some[a]], own[others[b]]
            apart = np.abs(rank[a, which] - rank[b, which])
            # a pair is taken once: the smaller place first, or one from each of two chunks
            once = side[b] == 1 if apart_chunks else a < b
            ok = once & (apart > s.window if large else apart <= s.window)
            ok &= group[a] == group[b]
            a, b = a[ok], b[ok]
            for q in range(which):
                new = (np.abs(rank[a, q] - rank[b, q]) > s.window) & (head[a, q] != head[b, q])
                a, b = a[new], b[new]
            if len(a):
                found.add(a, b, mult)
    return found.rows(rid)


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    least: float = 0.98,
    settings: Settings = Settings(),
) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``vectors``.

    Rows link if their labels are equal and not null, their vectors have equal
    lengths and a cosine of at least ``least``. Null and zero vectors and those
    with null or non-finite components link with nothing. n_links counts rows,
    so a repeated row is a vector more; component_id is the smallest id
    reachable, null ids aside; kept marks the rows that have it themselves.
    """
    s = settings
    fine = vectors.where(usable(vec_col) & name(label_col).isNotNull())
    fine = fine.select(name(id_col).alias("id"), name(label_col).alias("label"), name(vec_col).alias("vec"))
    reps = fine.groupBy("label", "vec").agg(F.count(F.lit(1)).alias("mult"), F.min("id").alias("least_id"))
    reps = reps.withColumns({"rid": F.monotonically_increasing_id(), "dim": F.size("vec"), "grp": F.xxhash64("label")})
    reps, _ = stored(reps, "vectors-distinct")
    # places in all passes
    placed = _projected(reps, s).join(reps.select("rid", "label", "dim"), "rid")
    placed = ranked(placed, ["pass", "label", "dim", "key", "rid"], "rank", "vectors-ranked")
    head = F.shiftrightunsigned("key", BITS - s.prefix)
    placed, _ = stored(placed.select("rid", "pass", "label", "dim", "rank", head.alias("head")), "vectors-placed")
    every = F.sort_array(F.collect_list(F.struct("pass", "rank", "head")))
    wide = placed.groupBy("rid").agg(every.alias("p"))
    wide = wide.select("rid", F.col("p.rank").alias("ranks"), F.col("p.head").alias("heads"))
    wide, _ = stored(wide.join(reps.select("rid", "vec", "dim", "mult", "grp"), "rid"), "vectors-wide")
    # windows: units of the order, each with the first rows of the next
    at = F.col("rank")
    unit = F.floor(at / s.unit)
    own = F.struct(unit.alias("unit"), F.lit(0).alias("side"))
    also = F.struct((unit - 1).alias("unit"), F.lit(1).alias("side"))
    both = F.when((at % s.unit < s.window) & (unit > 0), F.array(own, also)).otherwise(F.array(own))
    units = wide.select("*", F.posexplode("ranks").alias("pass", "rank")).select("*", F.explode(both).alias("u"))
    units = units.select("rid", "vec", "dim", "mult", "grp", "ranks", "heads", "pass", F.col("u.unit").alias("i"), F.lit(-1).cast("bigint").alias("j"), F.lit(-1).cast("bigint").alias("large"), F.col("u.side").alias("side"))
    # large groups: chunk i against chunk j
    runs = placed.groupBy("pass", "label", "dim", "head").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > s.window + 1)
    runs, _ = stored(runs, "vectors-runs")
    member = placed.join(runs, ["pass", "label", "dim", "head"])
    mine = F.floor((F.col("rank") - F.col("first")) / s.chunk)
    chunks = F.ceil(F.col("n") / s.chunk)
    pairs = F.transform(F.sequence(F.lit(0).cast("bigint"), chunks - 1), lambda c: F.struct(F.least(c, "mine").alias("i"), F.greatest(c, "mine").alias("j"), (c < F.col("mine")).cast("int").alias("side")))
    member = member.withColumn("mine", mine).select("rid", "pass", F.col("first").alias("large"), F.explode(pairs).alias("u"))
    groups = member.join(wide, "rid").select("rid", "vec", "dim", "mult", "grp", "ranks", "heads", "pass", F.col("u.i").alias("i"), F.col("u.j").alias("j"), "large", F.col("u.side").alias("side"))

    def run(key: tuple, t: pa.Table) -> pa.Table:
        which, first, i, j = (k.as_py() for k in key)
        got = _compare(t, which, first >= 0, first >= 0 and i != j, least, s)
        return pa.Table.from_batches([got])

    found = units.unionAll(groups).groupBy("pass", "large", "i", "j").applyInArrow(run, "rid bigint, n bigint, root bigint")
    found, _ = stored(found, "vectors-found")
    counts = found.groupBy("rid").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")), "vectors")
    full = reps.join(counts, "rid", "left").join(roots, reps["rid"] == roots["node"], "left")
    full = full.select("label", "vec", "least_id", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("root", "rid").alias("root"))
    full, _ = stored(full, "vectors-linked")
    home = full.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by = full.join(home, "root").select(F.col("label").alias("r_label"), F.col("vec").alias("r_vec"), "n_links", "component_id")
    rows = vectors.select(
        name(id_col).alias("id"),
        F.when(usable(vec_col) & name(label_col).isNotNull(), name(label_col)).alias("label"),
        F.when(usable(vec_col), name(vec_col)).alias("vec"),
    )
    done = rows.join(by, (rows["label"] == by["r_label"]) & (rows["vec"] == by["r_vec"]), "left")
    least_id = F.coalesce("component_id", "id")
    return done.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        least_id.alias("component_id"), F.coalesce(F.col("id") == least_id, F.lit(False)).alias("kept"),
    )
