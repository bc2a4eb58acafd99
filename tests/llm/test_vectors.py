"""Embedding de-duplication and nearest neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import embedding_dedup, neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int"
ODD = [
    (9000, None, 1), (9001, [0.0] * 16, 1), (9002, [float("nan")] + [1.0] * 15, 1), (9003, [float("inf")] + [1.0] * 15, 1),
    (9004, [None] + [1.0] * 15, 1), (9005, [], 1), (9006, [1.0, 2.0], 1), (9007, [2.0, 4.0], 1),
]


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    rows = []
    for c in range(40):
        centre = rng.standard_normal(16)
        for _ in range(rng.integers(1, 8)):
            rows.append((centre + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.14]), int(c % 4)))
    hot = rng.standard_normal(16)
    rows += [(hot + rng.standard_normal(16) * 0.08, 2) for _ in range(200)]
    rows += [(hot, 2)] * 30 + [(hot, 3), (hot * 7, 2)]
    rows += [(rng.standard_normal(16), int(rng.integers(0, 4))) for _ in range(200)]
    out = [(int(i), [float(np.float32(v)) for v in x], label) for i, (x, label) in zip(rng.permutation(len(rows)) * 3, rows, strict=True)]
    return out + [(7000, out[0][1], None)] + ODD


def linked(rows, least=0.98):
    fine = [
        (i, np.array(v, float), label)
        for i, v, label in rows
        if v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links = {i: set() for i, _, _ in rows}
    for n, (i, x, a) in enumerate(fine):
        for j, y, b in fine[n + 1 :]:
            if a == b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[i].add(j)
                links[j].add(i)
    home = {}
    for i in sorted(links):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in home:
                home[x] = i
                todo += links[x]
    return links, home


@pytest.mark.parametrize("settings", [embedding_dedup.Settings(), embedding_dedup.Settings(window=8, unit=32, chunk=40, prefix=6)])
def test_near_duplicates_match_brute_force(spark, vectors, settings):
    links, home = linked(vectors)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(vectors, SCHEMA), settings=settings).collect()}
    assert len(got) == len(vectors)
    found, true = sum(r["n_links"] for r in got.values()), sum(map(len, links.values()))
    assert 0.995 * true <= found <= true
    for i, r in got.items():
        assert r["n_links"] <= len(links[i]) and r["kept"] == (r["component_id"] == i)
        if not links[i]:
            assert r["component_id"] == i
    wrong = sum(got[i]["component_id"] != home[i] for i in got)
    assert wrong <= 0.01 * len(got)


def test_repeated_rows_null_ids_and_nothing(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (3, [1.0, 0.01], 1), (None, [1.0, 0.0], 1), (8, [0.0, 1.0], 1)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in got) == [
        (-1, 3, 3, False), (3, 3, 3, True), (5, 3, 3, False), (5, 3, 3, False), (8, 0, 8, True),
    ]
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def near_copies(n):
    """Heads of vectors around one centre, in all passes."""
    rng = np.random.default_rng(8)
    s = embedding_dedup.Settings()
    x = rng.standard_normal(64) + rng.standard_normal((n, 64)) * 0.05
    return embedding_dedup._keys(x, s) >> (embedding_dedup.BITS - s.prefix), s


def test_blocks_hold_what_earlier_passes_left():
    head, s = near_copies(300)
    every = np.arange(len(head))
    for which in (0, 1, 5, s.passes - 1):
        seen = np.zeros((len(head), len(head)), int)
        for rows, cols in embedding_dedup._blocks(every, every, head, which, s.window):
            assert len(rows) <= s.window
            seen[np.ix_(rows, cols)] += 1
        met = (head[:, None, :which] == head[None, :, :which]).any(2)
        assert (seen[~met] == 1).all() and seen.max() <= 1


def test_passes_multiply_a_large_group_few_times():
    """All passes together: the square of the group a few times, not once for each pass."""
    head, s = near_copies(1000)
    every, done = np.arange(len(head)), 0
    for which in range(s.passes):
        for h in np.unique(head[:, which]):
            own = every[head[:, which] == h]
            if len(own) > s.window + 1:
                done += sum(len(r) * len(c) for r, c in embedding_dedup._blocks(np.arange(len(own)), np.arange(len(own)), head[own], which, s.window))
    assert done <= 2 * len(head) ** 2


def nearest(rows, k):
    fine = [(i, np.array(v, float)) for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, x in fine:
        if i % 6 == 0:
            there = sorted((float(np.sqrt(((x - y) ** 2).sum())), j) for j, y in fine if j != i and len(x) == len(y))
            if there:
                out[i] = there[:k]
    return out


@pytest.mark.parametrize("settings", [neighbours.Settings(), neighbours.Settings(part=50, queries=30, block=3, share=0.8)])
def test_neighbours_reach_the_recall(spark, vectors, settings):
    df = spark.createDataFrame(vectors, SCHEMA).withColumns({"score": F.lit("clash"), "list": F.lit(0)})
    want = nearest(vectors, 10)
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 6 == 0, settings=settings).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert got.keys() == want.keys()
    hit = 0
    for q, there in got.items():
        there.sort()
        assert [r for r, _, _ in there] == list(range(1, len(want[q]) + 1))
        assert [x[1:] for x in there] == sorted(x[1:] for x in there)
        exact = dict((j, d) for d, j in nearest_to(vectors, q))
        assert all(abs(exact[j] - d) < 1e-12 for _, d, j in there)
        hit += len({j for _, _, j in there} & {j for _, j in want[q]})
    assert hit >= 0.95 * sum(map(len, want.values()))


def nearest_to(rows, q):
    x = np.array(next(v for i, v, _ in rows if i == q), float)
    return [(float(np.sqrt(((x - np.array(v, float)) ** 2).sum())), i) for i, v, _ in rows if v and len(v) == len(x) and all(c is not None for c in v)]


def test_fewer_candidates_than_asked_ties_and_nothing(spark):
    rows = [(0, [0.0, 1.0], 1), (2, [1.0, 1.0], 1), (1, [-1.0, 1.0], 1), (3, [0.0, 0.0], 1), (4, [0.0, 3.0], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = neighbours.search(df.unionAll(df), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 4, 2.0)]
    assert neighbours.search(df.where("false"), F.lit(True)).count() == 0
    assert neighbours.search(df, F.lit(False)).count() == 0


@pytest.mark.parametrize("settings", [neighbours.Settings(), neighbours.Settings(part=4, queries=3)])
def test_vectors_of_each_length_are_searched(spark, settings):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(2 if i % 7 else 3).tolist(), 1) for i in range(90)] + [(1000 + i, rng.standard_normal(5).tolist(), 1) for i in range(2)]
    rows += [(7000, [1.0] * 9, 1)]  # nothing to compare with
    got = {}
    for r in neighbours.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, k=4, settings=settings).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    for i, v, _ in rows:
        near = sorted((math.dist(v, w), j) for j, w, _ in rows if len(w) == len(v) and j != i)[:4]
        if i % 10 == 0 and near:
            assert len(got[i]) == len(near) and len({j for _, j in got[i]} & {j for _, j in near}) >= len(near) - 2
        elif i % 10 == 0:
            assert i not in got


def test_scan_leaves_no_pair_within_the_bound_at_full_width():
    rng = np.random.default_rng(1)
    q, x = rng.standard_normal((20, 24)), rng.standard_normal((300, 24))
    bound = np.full(20, 30.0)
    a, b = neighbours._scan(q, x, bound, neighbours.Settings(block=8, eps=50.0))
    exact = ((q[:, None] - x[None]) ** 2).sum(2)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == set(zip(*(v.tolist() for v in np.nonzero(exact <= 30.0)), strict=True))
