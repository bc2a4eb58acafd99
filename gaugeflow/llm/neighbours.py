"""Nearest neighbours by an inverted file with an adaptive dimension scan.

Index. Centroids are fitted on a bounded sample (``sample`` rows, those whose id
has the smallest hash), for vectors of each length by themselves; every row goes to
the list of its nearest centroid. Lists become more as rows do, up to a sixteenth of the sample.

Search. A query probes its nearest lists until they hold ``share`` of all rows of its length.
Lists are cut into parts of about ``part`` rows, so a list that holds a third
of all rows is many parts. Queries are sent to the parts of the lists they probe; rows are sent
once, and only those of lists that are probed. A task holds one part, and the queries
for it pass by in batches. The vectors
are rotated at random and compared in column blocks. After d of D columns a
candidate is tested: its squared distance over these columns, scaled to D, has
to be under the bound times (1 + eps / sqrt(d)) squared, the hypothesis being
that it is within the bound; those that fail are left, the rest go on to the next
columns. The bound is the k-th best distance so far: the list nearest to each
query is searched first by itself, and its k-th distance is where the others start.

What is left is measured on the original vectors in double precision. A part
returns at most k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import name, stored, type_of
from gaugeflow.llm.vectors import matrix, usable


@dataclass(frozen=True)
class Settings:
    sample: int = 16_384  # rows that centroids are fitted on, at most
    n_lists: int = 256  # at least, where the sample is large enough
    rounds: int = 12
    share: float = 0.65  # of all rows, in the lists that a query probes
    part: int = 4_096  # rows of a list in a group, about
    queries: int = 2_048  # queries compared at a time
    block: int = 16  # columns between two tests
    eps: float = 2.1
    seed: int = 8


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(1) - 2 * (x @ centroids.T), axis=1)


def _centroids(x: np.ndarray, n: int, s: Settings) -> np.ndarray:
    """About ``n`` of them: k-means from rows of the sample; a list that loses all its rows keeps its centroid."""
    n = max(1, min(n, len(x) // 16))
    rng = np.random.default_rng(s.seed)
    c = x[rng.choice(len(x), n, replace=False)].copy()
    for _ in range(s.rounds):
        at = np.concatenate([_nearest(x[i : i + 4096], c) for i in range(0, len(x), 4096)])
        size = np.bincount(at, minlength=n)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    return c


def _rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _scan(q: np.ndarray, x: np.ndarray, bound: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row), rotated, that pass all tests against the queries' squared bounds."""
    dim = x.shape[1]
    d = min(s.block, dim)
    part = (q[:, :d] ** 2).sum(1)[:, None] + (x[:, :d] ** 2).sum(1)[None] - 2 * (q[:, :d] @ x[:, :d].T)
    allow = lambda k: (k / dim) * ((1 + s.eps / np.sqrt(k)) ** 2 if k < dim else 1) * (1 + 1e-9)
    slack = 1e-9 * ((q**2).sum(1).max(initial=0) + (x**2).sum(1).max(initial=0))
    a, b = np.nonzero(part <= (bound * allow(d) + slack)[:, None])
    sums = part[a, b]
    while d < dim and len(a):
        to = min(d + s.block, dim)
        sums = sums + ((q[a, d:to] - x[b, d:to]) ** 2).sum(1)
        d = to
        keep = sums <= bound[a] * allow(d) + slack
        a, b, sums = a[keep], b[keep], sums[keep]
    return a, b


def _best(
    q: np.ndarray, own: np.ndarray, bound: np.ndarray, x: np.ndarray, code: np.ndarray, k: int, turn: np.ndarray, s: Settings
) -> list[np.ndarray]:
    """Per query at most k rows of the group: (query, row, distance).

    ``own`` and ``code`` are the ids of queries and rows as ordered numbers;
    ``bound`` is squared, and lowered on the way.
    """
    qr, xr = q @ turn, x @ turn
    held = [np.empty(0, np.int64)] * 2 + [np.empty(0)]
    for i in range(0, len(x), 512):
        a, b = _scan(qr, xr[i : i + 512], bound, s)
        b = b + i
        differ = own[a] != code[b]
        a, b = a[differ], b[differ]
        exact = np.sqrt(((q[a] - x[b]) ** 2).sum(1))
        a, b, exact = (np.concatenate([h, n]) for h, n in zip(held, (a, b, exact), strict=True))
        by = np.lexsort((code[b], exact, a))
        a, b, exact = a[by], b[by], exact[by]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        held = [a[place < k], b[place < k], exact[place < k]]
        full = place == k - 1
        bound[a[full]] = np.minimum(bound[a[full]], exact[full] ** 2)
    return held


def search(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """(query_id, rank, id, score): per query row the ``k`` nearest found, nearest first, ties to the smaller id.

    score is the Euclidean distance. Rows with the query's id aren't its
    candidates, nor are vectors of another length; equal rows count once. Null and zero vectors,
    those with null or non-finite components and rows without id take no part. With fewer than
    ``k`` candidates all are returned. An empty table gives an empty result.
    """
    s, spark = settings, vectors.sparkSession
    id_type = type_of(vectors, id_col)
    rows = vectors.where(usable(vec_col) & name(id_col).isNotNull())
    rows = rows.select(name(id_col).alias("id"), name(vec_col).cast("array<double>").alias("vec"), is_query.alias("asks")).distinct()
    schema = f"query_id {id_type}, rank int, `{id_col}` {id_type}, score double"
    of_length = {r["n"]: r["rows"] for r in rows.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("rows")).collect()}  # a row per length
    if not of_length:
        return spark.createDataFrame([], schema)
    some = rows.select("vec", F.xxhash64("id").alias("h")).orderBy("h").limit(s.sample).select("vec").collect()
    lists: dict[int, tuple[int, np.ndarray]] = {}  # by length: number of the first list, centroids
    at = 0
    for dim, n in sorted(of_length.items()):
        x = np.array([r[0] for r in some if len(r[0]) == dim], np.float64).reshape(-1, dim)
        lists[dim] = (at, _centroids(x, max(s.n_lists, n // s.part), s) if len(x) else np.zeros((1, dim)))
        at += len(lists[dim][1])

    def lengths(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Vectors of a batch by length: (length, their places, the matrix)."""
        size = pc.list_value_length(column).to_numpy()
        for dim in np.unique(size):
            where = np.flatnonzero(size == dim)
            yield int(dim), where, matrix(column.take(pa.array(where)), int(dim))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            to = np.zeros(b.num_rows, np.int32)
            for dim, where, x in lengths(b.column(1)):
                to[where] = lists[dim][0] + _nearest(x, lists[dim][1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(to)], [*b.schema.names, "list"])

    index, _ = stored(rows.mapInArrow(assign, f"id {id_type}, vec array<double>, asks boolean, list int"), "neighbours-index")
    counts = {r["list"]: r["count"] for r in index.groupBy("list").count().collect()}  # a row per list
    held = np.array([counts.get(i, 0) for i in range(at)], np.int64)
    asked = index.where("asks").select("id", "vec")
    parts = [max(1, -(-int(n) // s.part)) for n in held]
    cuts = F.element_at(F.array(*[F.lit(n) for n in parts]), F.col("list") + 1)

    def probe(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for dim, where, x in lengths(b.column("vec")):
                    base, centroids = lists[dim]
                    size = held[base : base + len(centroids)]
                    order = np.argsort((centroids**2).sum(1) - 2 * (x @ centroids.T), axis=1, kind="stable")
                    before = np.cumsum(size[order], axis=1) - size[order]
                    take = (before < max(s.share * size.sum(), k + 1)) & (size[order] > 0)
                    nearest = np.cumsum(take, axis=1) == 1
                    take &= nearest if first else ~nearest
                    row, place = np.nonzero(take)
                    got = b.take(pa.array(where[row]))
                    to = pa.array((base + order[row, place]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([*got.columns, to], [*got.schema.names, "list"])

        return run

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a part, then the queries for it; parts come one after the other."""
        now, held_ids, held_rows, x, turns = None, [], [], None, {}
        for b in batches:
            keys = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("list", "part", "asks")])
            edges = np.r_[0, np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1, b.num_rows] if b.num_rows else [0]
            for a, z in zip(edges[:-1], edges[1:], strict=True):
                key, asks = tuple(keys[:2, a]), bool(keys[2, a])
                vec = b.column("vec").slice(a, z - a)
                dim = len(vec[0])
                if key != now:
                    now, held_ids, held_rows, x = key, [], [], None
                if not asks:
                    held_ids.append(b.column("id").slice(a, z - a))
                    held_rows.append(matrix(vec, dim))
                    continue
                if not held_rows:
                    continue
                if x is None:
                    x, ids = np.concatenate(held_rows), pa.concat_arrays(held_ids)
                    if dim not in turns:
                        turns = {dim: _rotation(dim, s.seed)}
                for i in range(a, z, s.queries):
                    n = min(s.queries, z - i)
                    mine = b.column("id").slice(i, n)
                    codes = pc.rank(pa.concat_arrays([mine, ids]), tiebreaker="dense").to_numpy().astype(np.int64)
                    bound = b.column("bound").slice(i, n).to_numpy(zero_copy_only=False).astype(np.float64) ** 2
                    q, r, score = _best(matrix(b.column("vec").slice(i, n), dim), codes[:n], bound, x, codes[n:], k, turns[dim], s)
                    if len(q):
                        yield pa.RecordBatch.from_arrays([mine.take(pa.array(q)), ids.take(pa.array(r)), pa.array(score)], ["qid", "id", "score"])

    stay = index.select("id", "vec", "list", F.pmod(F.xxhash64("id", F.lit(s.seed)), cuts).cast("int").alias("part"), F.lit(False).alias("asks"), F.lit(None).cast("double").alias("bound"))

    def answers(asks: DataFrame) -> DataFrame:
        """``asks``: id, vec, list, bound."""
        probed = [r["list"] for r in asks.select("list").distinct().collect()]  # lists at most
        placed = asks.select("id", "vec", "list", F.explode(F.sequence(F.lit(0), cuts - 1)).alias("part"), F.lit(True).alias("asks"), "bound")
        met = stay.where(F.col("list").isin(probed)).unionAll(placed)
        met = met.repartition("list", "part").sortWithinPartitions("list", "part", "asks")
        return met.mapInArrow(scan, f"qid {id_type}, id {id_type}, score double")

    ranks = Window.partitionBy("qid").orderBy("score", "id")
    best = lambda df: df.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= k)
    probes = f"id {id_type}, vec array<double>, list int"
    near = asked.mapInArrow(probe(True), probes).withColumn("bound", F.lit(float("inf")))
    near, _ = stored(best(answers(near)), "neighbours-first")
    bounds = near.groupBy(F.col("qid").alias("b_id")).agg(F.max(F.when(F.col("rank") == k, F.col("score"))).alias("b"))
    more = asked.mapInArrow(probe(False), probes)
    more = more.join(bounds, more["id"] == bounds["b_id"], "left").select("id", "vec", "list", F.coalesce("b", F.lit(float("inf"))).alias("bound"))
    found = best(near.drop("rank").unionAll(answers(more)).distinct())
    return found.select(F.col("qid").alias("query_id"), "rank", F.col("id").alias(id_col), "score")
