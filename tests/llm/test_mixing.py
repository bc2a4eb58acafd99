"""Targets, permutations and the mix."""

import random

import pytest
from conftest import under
from pyspark.sql import functions as F

from gaugeflow.llm import mixing


def shares(sizes):
    """Targets by resharing the excess until none is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, full, rest = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in full]
        total = sum(weight[s] for s in free)
        target |= {s: rest * weight[s] / total for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s] * (1 + 1e-12)]
        if not over:
            return target
        for s in over:
            target[s] = 3.0 * sizes[s]
            full.add(s)
            rest -= target[s]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        source = rng.choice(["big"] * 8 + ["a", "b", "Ä", "ä", "tiny", None])
        words = 5 if source == "tiny" else rng.randint(0, 120)
        rows.append((i, " ".join(f"w{i}x{j}" for j in range(words)), source))
    rows += [(1000, None, "a"), (1001, " \n", "b"), (1002, "z " * 20000, "big"), (None, "one two three", "a"), (1003, "x", "void"), (1004, None, "none")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns(
        {"n_chars": F.length("text").cast("bigint"), "size": F.lit("clash"), "epoch": F.lit(1)}
    )


def sizes_of(rows):
    out = {}
    for r in rows:
        out[r["source"]] = out.get(r["source"], 0) + len((r["text"] or "").split())
    return out


def test_targets_and_taken_words(spark, docs):
    s = mixing.Settings(block=16, slots=32, chunk=8)
    rows = docs.collect()
    sizes, got = sizes_of(rows), mixing.report(docs, settings=s).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    want, taken = shares(sizes), {}
    for r in rows:
        g = by[r["doc_id"]]
        assert g["size"] == len((r["text"] or "").split()) and g["source_size"] == sizes[r["source"]]
        assert g["target"] == pytest.approx(want[r["source"]])
        assert g["taken"] <= 3 * g["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + g["taken"]
    for source, target in want.items():
        assert taken[source] == pytest.approx(target, rel=0.03, abs=1)
    again = mixing.report(docs.repartition(7), settings=s).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_mix_documents_holds_the_taken_words(spark, docs):
    s = mixing.Settings(block=16, slots=32, chunk=8)
    mixed = mixing.mix_documents(docs, settings=s)
    assert mixed.columns == docs.columns
    took, whole = {}, {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixed.collect():
        words = r["text"].split()
        assert words and set(words) <= set(whole[r["doc_id"]].split()) and r["n_chars"] == len(r["text"])
        took[r["doc_id"]] = took.get(r["doc_id"], 0) + len(words)
    assert took == {r["doc_id"]: r["taken"] for r in mixing.report(docs, settings=s).collect() if r["taken"]}


def test_slots_are_full_and_each_round_takes_a_block_once(spark, docs):
    m = mixing.mix(docs, settings=mixing.Settings(block=16, slots=32, chunk=8))
    taken, sources = m.taken.collect(), {r["source"]: r for r in m.sources.collect()}
    assert len({(r["shard"], r["slot"]) for r in taken}) == len(taken) == sum(r["quota"] for r in sources.values())
    assert len({(r["source"], r["epoch"], r["block"]) for r in taken}) == len(taken)
    for name, r in sources.items():
        assert sum(x["source"] == name for x in taken) == r["quota"]
    # the counts of a shard vary as draws do
    first = [sum(x["source"] == "big" for x in taken if x["shard"] == k) for k in {x["shard"] for x in taken}]
    assert len(set(first)) > 1


def test_small_sources_come_near_their_targets(spark):
    rows = [(100 * s + i, " ".join(f"w{s}x{j}" for j in range(20)), f"host{s:02d}") for s in range(60) for i in range(5)]
    rows += [(9000 + i, " ".join("y" * 7 for _ in range(333)), "large") for i in range(40)]
    got = mixing.report(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    source, taken, target = {i: s for i, _, s in rows}, {}, {}
    for r in got:
        taken[source[r["doc_id"]]] = taken.get(source[r["doc_id"]], 0) + r["taken"]
        target[source[r["doc_id"]]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert all(taken[s] == pytest.approx(t, rel=0.03) for s, t in target.items())
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.01)


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation(spark, n):
    rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(9).cast("bigint")).alias("p")).collect()
    got = [r["p"] for r in rows]
    assert sorted(got) == list(range(n)) and (n < 64 or got != list(range(n)))


def test_repeated_rows_and_nothing(spark):
    rows = [(1, "a b c d", "s"), (1, "a b c d", "s"), (1, "other words", "s"), (2, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.report(df).collect()
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in got) == [(1, 2, 6, 2), (1, 4, 6, 4), (1, 4, 6, 4), (2, 0, 0, 0)]
    none = df.where("false")
    assert mixing.report(none).count() == 0 and mixing.mix_documents(none).count() == 0


def test_slots_are_numbered_without_a_broadcast_of_all(spark, tmp_path):
    spark.range(20000).selectExpr("floor(id / 100) AS shard", "id AS slot", "CAST(id * 7 % 5 AS INT) AS at").write.parquet(f"{tmp_path}/drawn")
    sources = spark.range(5).selectExpr("CAST(id AS INT) AS at", "10 * id AS quota")
    numbered = mixing._numbered(spark.read.parquet(f"{tmp_path}/drawn"), sources)
    slots = sorted(numbered.collect(), key=lambda r: r["slot"])
    got = {at: [(r["i"], r["quota"]) for r in slots if r["at"] == at] for at in range(5)}
    assert got == {at: [(i, 10 * at) for i in range(4000)] for at in range(5)}
    final = numbered._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert under(final, "row_number") and not under(final, "BroadcastExchange", "row_number")
