"""A Merkle manifest of a table: leaves, roots, a proof for every row, and its verification.

Rows are the leaves of one tree per group (a source), in the order of their ids;
``arity`` consecutive nodes become one, until one is left, the subroot. The subroots
are the leaves of the last tree, whose root stands for the whole table.

Digests travel by time-forward processing. A node has a label, its level and its
place, that sorts after those of all its children; a digest is sent to the
parent under the parent's label, and a priority queue ordered by label delivers
it when the parent is due. The queue is external in two stages: trees are cut into
*runs*, subtrees of ``band`` levels over ``arity ** band`` neighbouring nodes,
Spark's sorted shuffle by (tree, run) delivers digests between runs, and a heap
does so within one, which is all that a task holds. Each band reduces the number of
nodes by thousands, so a few rounds reach the root. The reversed sweep goes the same way
backwards: by falling labels each node gets the suffix of its proof, the
siblings from its parent's level to the root, and passes it on to its children with their
siblings in front, down to the leaves.

Places come from one range-partitioned sort of all rows; no task holds a group.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.common import name, stored, type_of
from gaugeflow.llm.vectors import ranked

NODE = "tree bigint, place bigint, size bigint, digest string"
PATH = "tree bigint, place bigint, at array<tinyint>, siblings array<string>"


@dataclass(frozen=True)
class Settings:
    arity: int = 3
    band: int = 8  # levels of a run: 6,561 nodes


def field(value: Column) -> Column:
    """A value as part of a leaf: UTF-8 byte count, colon, value; - for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _digest(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def levels(size: int, s: Settings) -> int:
    """Levels from so many leaves to the root."""
    n = 0
    while size > 1:
        size, n = -(-size // s.arity), n + 1
    return n


def _sweep(digests: list[str], depth: int, s: Settings) -> dict[tuple[int, int], list[str]]:
    """The children's digests of every node of a run, up to its root at level ``depth``."""
    queue = [(1, i // s.arity, i, d) for i, d in enumerate(digests)]  # ordered by label, so a heap as it is
    below: dict[tuple[int, int], list[str]] = {}
    while queue:
        level, place = queue[0][:2]
        got = []
        while queue and queue[0][:2] == (level, place):
            got.append(heapq.heappop(queue)[3])
        below[level, place] = got
        if level < depth:
            heapq.heappush(queue, (level + 1, place // s.arity, place, _digest(got)))
    return below


def _up(s: Settings):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        size, tree, at = table["size"][0].as_py(), key[0].as_py(), key[1].as_py()
        depth = min(levels(size, s), s.band)
        digests = table["digest"].to_pylist()
        root = _digest(_sweep(digests, depth, s)[depth, 0]) if depth else digests[0]
        return pa.table({"tree": [tree], "place": [at], "size": [-(-size // s.arity**depth)], "digest": [root]})

    return run


def _reversed(digests: list[str], depth: int, at: list[int], siblings: list[str], s: Settings) -> list[tuple[list[int], list[str]]]:
    """Proofs of a run's nodes, given that of its root: per level the number of siblings to the left, and all siblings' digests."""
    if not depth:
        return [(at, siblings)] * len(digests)
    below = _sweep(digests, depth, s)
    queue = [(-depth, 0, at, siblings)]
    out: list = [None] * len(digests)
    while queue:
        level, place, at, siblings = heapq.heappop(queue)
        got = below[-level, place]
        for i in range(len(got)):
            message = ([i, *at], ["".join(got[:i] + got[i + 1 :]), *siblings])
            if level == -1:
                out[place * s.arity + i] = message
            else:
                heapq.heappush(queue, (level + 1, place * s.arity + i, *message))
    return out


def fold(digest: str, at: list[int], siblings: list[str]) -> str:
    """The root that a digest and a proof lead to."""
    for i, others in zip(at, siblings, strict=True):
        digest = _digest([others[: 64 * i], digest, others[64 * i :]])
    return digest


def _down(s: Settings, leaves: bool):
    """Proofs of the nodes of a run; at the ``leaves``, their digest and the roots they fold to."""

    def run(nodes: pa.Table, paths: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("place")
        depth = min(levels(nodes["size"][0].as_py(), s), s.band)
        got = _reversed(nodes["digest"].to_pylist(), depth, paths["at"][0].as_py(), paths["siblings"][0].as_py(), s)
        if not leaves:
            at, siblings = [g[0] for g in got], [g[1] for g in got]
            return pa.table(
                [nodes["tree"], nodes["place"], pa.array(at, pa.list_(pa.int8())), pa.array(siblings, pa.list_(pa.string()))],
                ["tree", "place", "at", "siblings"],
            )
        shown = nodes["shown"].to_pylist()
        return pa.table(
            [
                nodes["tree"], nodes["id"], nodes["digest"], pa.array([_digest(g[1]) for g in got]),
                pa.array([fold(d, *g) for d, g in zip(shown, got, strict=True)]),
            ],
            ["tree", "id", "leaf", "proof", "folded"],
        )

    return run


def _runs(s: Settings) -> Column:
    return F.floor(F.col("place") / F.lit(s.arity**s.band)).cast("bigint")


def _bands(nodes: DataFrame, most: int, s: Settings, label: str) -> list[DataFrame]:
    """The nodes at the foot of every band, and last the roots. ``most``: leaves of the largest tree."""
    found = [nodes]
    while most > 1:
        up = found[-1].select("tree", "place", "size", "digest").groupBy("tree", _runs(s).alias("run")).applyInArrow(_up(s), NODE)
        found.append(stored(up, label)[0])
        most = -(-most // s.arity**s.band)
    return found


def _proofs(bands: list[DataFrame], paths: DataFrame, s: Settings, leaves: str = "") -> DataFrame:
    """From the proofs of the roots to those of the nodes at the foot of the first band; ``leaves``: its schema if these are rows."""
    for i, nodes in reversed(list(enumerate(bands[:-1]))):
        last = bool(leaves) and i == 0
        paths = (
            nodes.groupBy("tree", _runs(s).alias("run"))
            .cogroup(paths.groupBy("tree", "place"))
            .applyInArrow(_down(s, last), leaves if last else PATH)
        )
    return paths


def manifest(
    docs: DataFrame,
    id_col: str,
    group_col: str,
    values: list[Column],
    shown: list[Column] | None = None,
    changed: Column | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of ``values``. What is verified are the values ``shown``,
    as somebody received them, of rows for which ``changed`` holds, and ``values`` of all others: their
    leaf is folded with the proof made from the table. ``proof_sha256`` is the digest
    of the proof's digests, that of the empty text for the only row of a table.

    Groups are in byte order, null first; within a group leaves go by id, null
    first, and by digest among equal ids, so repeated rows are leaves of their
    own and any order of the input gives one root. Empty and long texts
    are values like others; extra columns play no part. An empty table gives an empty result.
    """
    s, spark = settings, docs.sparkSession
    own = leaf(values)
    seen = own if shown is None else F.when(F.coalesce(changed, F.lit(False)), leaf(shown)).otherwise(own)
    rows = docs.select(name(id_col).alias("id"), name(group_col).alias("source"), own.alias("digest"), seen.alias("shown"))
    rows, _ = stored(rows, "merkle-rows")  # texts are read once; what follows sees digests
    rows = ranked(rows, ["source", "id", "digest", "shown"], "at", "merkle-leaves")
    # a tree is known by the place of its first leaf
    trees = rows.groupBy("source").agg(F.min("at").alias("tree"), F.count(F.lit(1)).alias("size"))
    trees, _ = stored(ranked(trees, ["tree"], "place", "merkle-sources"), "merkle-trees")
    leaves = (
        rows.join(trees.drop("place").withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
        .select("tree", (F.col("at") - F.col("tree")).alias("place"), "size", "digest", "shown", "id")
    )
    leaves, _ = stored(leaves, "merkle-nodes")
    count, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    bands = _bands(leaves, most, s, "merkle-band")
    subroots = bands[-1].select("tree", F.col("digest").alias("subroot"))
    top = trees.join(subroots, "tree").select(
        F.lit(-1).cast("bigint").alias("tree"), "place", F.lit(count).cast("bigint").alias("size"), F.col("subroot").alias("digest")
    )
    tops = _bands(stored(top, "merkle-top")[0], count, s, "merkle-band")
    root = (tops[-1].select("digest").first() or [None])[0]
    none = spark.createDataFrame([(-1, 0, [], [])], PATH)
    paths = _proofs(tops, none, s).select("place", "at", "siblings")
    paths = trees.select("tree", "place").join(paths, "place").select("tree", F.lit(0).cast("bigint").alias("place"), "at", "siblings")
    if len(bands) == 1:  # one leaf a tree: a band of no levels
        bands = [leaves, leaves]
    schema = f"tree bigint, id {type_of(docs, id_col)}, leaf string, proof string, folded string"
    proofs = _proofs(bands, stored(paths, "merkle-paths")[0], s, schema)
    return proofs.join(subroots, "tree").select(
        F.col("id").alias(id_col), "leaf", "subroot", F.lit(root).cast("string").alias("root"), F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"), (F.col("folded") == F.lit(root)).alias("verified"),
    )
