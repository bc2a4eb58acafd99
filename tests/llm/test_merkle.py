"""The Merkle manifest against a tree built by hand."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import merkle
from gaugeflow.llm.merkle import Settings

SCHEMA = "doc_id bigint, source string, text string, leaf string, place int"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    texts = [None if v is None else str(v) for v in values]
    return digest(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def tree(leaves, arity):
    """The root, and per leaf its siblings level by level with their places."""
    paths, now = [[] for _ in leaves], list(leaves)
    under = [[i] for i in range(len(leaves))]
    while len(now) > 1:
        up, above = [], []
        for a in range(0, len(now), arity):
            run = now[a : a + arity]
            for k in range(len(run)):
                for i in under[a + k]:
                    paths[i].append((run[:k], run[k + 1 :]))
            up.append(digest(*run))
            above.append([i for u in under[a : a + arity] for i in u])
        now, under = up, above
    return now[0], paths


def brute(rows, arity, changed):
    first = lambda v: (v is not None, v if not isinstance(v, str) else v.encode())
    sources = sorted({r[1] for r in rows}, key=first)
    groups, out = [], []
    for s in sources:
        group = [(r[0], leaf_of(*r), leaf_of(*r[:2], r[2] and r[2].replace("\n", "")) if changed(r) else leaf_of(*r)) for r in rows if r[1] == s]
        group.sort(key=lambda g: (first(g[0]), g[1:]))
        groups.append((group, *tree([g[1] for g in group], arity)))
    root, above = tree([g[1] for g in groups], arity)
    for (group, subroot, paths), more in zip(groups, above, strict=True):
        for (i, leaf, shown), path in zip(group, paths, strict=True):
            fold = shown
            for before, after in path + more:
                fold = digest(*before, fold, *after)
            proof = digest(*[d for before, after in path + more for d in before + after])
            out.append((i, leaf, subroot, root, proof, fold, fold == root))
    return sorted(out, key=repr)


def manifest(spark, rows, settings):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumns({c: F.lit("mine") for c in ("leaf", "place", "id", "at", "digest")})
    values = [F.col("doc_id"), F.col("source"), F.col("text")]
    shown = [*values[:2], F.replace("text", F.lit("\n"), F.lit(""))]
    return merkle.manifest(docs.repartition(3), "doc_id", "source", values, shown, F.col("doc_id") % 2 == 0, settings)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("settings", [Settings(), Settings(band=1), Settings(band=2), Settings(arity=2, band=3)])
def test_manifest_matches_brute_force(spark, settings):
    rng = random.Random(4)
    rows = []
    for s, n in ((None, 5), ("", 1), ("a", 1), ("b", 3), ("ü", 4), ("z", 28), ("hot", 90)):
        rows += [(i, s, rng.choice(["x", "a\nb", "", None, "é\n"]) and f"{i}\n{s}") for i in range(n)]
    rows += [(None, "b", None), (None, "b", "no id\n"), (2, "b", "again\n"), (2, "b", "again\n"), (7, "hot", "x\n" * 100_000)]
    got = manifest(spark, rows, settings)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found(got) == brute(rows, settings.arity, lambda r: r[0] is not None and r[0] % 2 == 0)


def test_one_row_and_none(spark):
    (row,) = manifest(spark, [(1, "a", "x\n")], Settings()).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"] and row["proof_sha256"] == digest()
    assert manifest(spark, [], Settings()).count() == 0
    assert found(manifest(spark, [(2, "a", "x\n"), (3, "a", "y")], Settings())) == brute([(2, "a", "x\n"), (3, "a", "y")], 3, lambda r: r[0] == 2)


def test_order_and_spread_of_the_input_do_not_matter(spark):
    rows = [(i, "ab"[i % 2], f"t{i}") for i in range(40)]
    assert found(manifest(spark, rows, Settings(band=1))) == found(manifest(spark, rows[::-1], Settings()))
