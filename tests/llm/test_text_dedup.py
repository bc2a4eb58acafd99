"""SimHash and substring de-duplication against brute force."""

import hashlib
import random

import pytest
import xxhash
from conftest import under
from pyspark.sql import functions as F

from gaugeflow.llm import simhash, substring
from gaugeflow.llm.common import components, running_sum

SPACE = b" \t\n\x0b\x0c\r"


def words_of(text):
    return (text or "").encode().split()


def fingerprint(text):
    words = [w.lower() for w in words_of(text)]
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(ids, linked):
    """Smallest id reachable, by flooding."""
    least = {}
    for i in sorted(ids):
        if i in least:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in least:
                least[x] = i
                todo += [y for y in ids if y not in least and linked(x, y)]
    return least


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    made = list(base)
    for t in base[:25]:
        words = t.split()
        for _ in range(3):
            again = list(words)
            again[rng.randrange(len(words))] = rng.choice(vocabulary)
            made.append(" ".join(again))
    made += base[:10] + [None, "", " \t\n", "one", "One", "two words", "a b c d e", "ÄÖ äö ÄÖ", "x" * 5000]
    made.append(" ".join(rng.choice(vocabulary[:30]) for _ in range(30000)))
    return list(enumerate(made))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"fingerprint": F.lit("mine"), "n_words": F.lit(-1), "component_id": F.lit("x")}
    )


def test_simhash_matches_brute_force(spark, texts):
    prints = {i: fingerprint(t) for i, t in texts}
    least = grouped(list(prints), lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 3)
    for long_list in (2000, 1):
        got = simhash.near_duplicates(frame(spark, texts), long_list=long_list).collect()
        assert {r["doc_id"]: r["fingerprint"] % 2**64 for r in got} == prints
        assert {r["doc_id"]: r["component_id"] for r in got} == least


def test_simhash_broadcasts_no_exploded_table(spark):
    """Spark takes an exploded table to be as small as the one before; of its 35 or 2081 rows for each none may go to the driver."""
    fps = spark.createDataFrame([(i * 0x9E3779B97F4A7C15 % 2**62 ^ 1 << b,) for i in range(20) for b in range(3)], "fp bigint")
    for long_list in (2000, 1):
        links = simhash.links(fps, long_list=long_list)
        assert links.count() and links.collect()
        final = links._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert under(final, "Generate") and not under(final, "BroadcastExchange", "Generate")


def test_simhash_of_chunks_is_that_of_the_whole():
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdefgh") * 40 for _ in range(60000))
    assert simhash.simhash(text.encode(), 3) % 2**64 == fingerprint(text)


def test_keep_one_keeps_one_row_of_each_group(spark, texts):
    rows = texts + [(0, texts[0][1]), (0, "something else that shares the id zero"), (None, texts[1][1]), (None, "no id at all here")]
    docs = frame(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    prints = {i: fingerprint(t) for i, t in enumerate([t for _, t in rows])}
    least = grouped(list(prints), lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 3)
    assert len(got) == len(set(least.values()))
    assert (None, "no id at all here") in {(r["doc_id"], r["text"]) for r in got}
    assert sum(r["doc_id"] == 0 and r["text"] == texts[0][1] for r in got) == 1


def test_simhash_of_nothing(spark):
    none = frame(spark, [])
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5), (None, 4)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000} | {2000 + i: 1000 for i in range(300)}


def test_running_sum(spark):
    rows = [(k, i, (i * 7) % 5) for k in ("a", None) for i in range(50)]
    got = running_sum(spark.createDataFrame(rows, "k string, i bigint, v bigint"), ["k"], "i", "v", "s", step=8).collect()
    assert all(r["s"] == sum((j * 7) % 5 for j in range(r["i"])) for r in got) and len(got) == 100


def without_repeats(rows, width=20):
    seen, out = {}, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = words_of(text)
        gone = [False] * len(words)
        for a in range(len(words) - width + 1):
            run = tuple(words[a : a + width])
            if seen.setdefault(run, (i, a)) != (i, a):
                gone[a : a + width] = [True] * width
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(5)
    word = lambda: f"v{rng.randrange(3000)}"
    shared = [[word() for _ in range(n)] for n in (19, 20, 21, 60, 200)]
    rows = []
    for i in range(80):
        words = [word() for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(shared)
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, None), (103, ""), (104, "again " * 50), (105, "again\n" * 25)]
    rows += [(106, " ".join(word() for _ in range(20000)) + " " + " ".join(shared[3])), (107, "é " * 30 + "  " * 30)]
    return rows


@pytest.mark.parametrize("settings", [substring.Settings(), substring.Settings(max_bytes=1, depth=1), substring.Settings(gram=20)])
def test_substrings_match_brute_force(spark, passages, settings):
    got = substring.remove_repeats(frame(spark, passages).repartition(5), settings=settings)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in got.collect()} == without_repeats(passages)


def test_substring_rows_that_share_an_id_or_have_none(spark):
    text, other = " ".join(f"a{i}" for i in range(25)), " ".join(f"b{i}" for i in range(25))
    rows = [(1, text), (1, text), (1, other), (None, other), (2, text)]
    got = substring.remove_repeats(frame(spark, rows)).collect()
    found = sorted((r["doc_id"] or 0, r["text"] == text, r["n_removed"]) for r in got)
    assert found == [(0, False, 0), (1, False, 25), (1, True, 0), (1, True, 0), (2, True, 25)]


def test_cut_documents_keeps_rows_and_columns(spark, passages):
    docs = frame(spark, passages).withColumn("n_chars", F.length("text"))
    got = substring.cut_documents(docs)
    assert got.columns == docs.columns and got.count() == len(passages)
    want, whole = without_repeats(passages), dict(passages)
    for r in got.collect():
        assert len(words_of(r["text"])) == want[r["doc_id"]][0] - want[r["doc_id"]][1]
        if not want[r["doc_id"]][1]:
            assert r["text"] == whole[r["doc_id"]]
        assert r["n_chars"] == (len(r["text"]) if r["text"] is not None else None)
        assert r["fingerprint"] == "mine" and r["n_words"] == -1


def test_substrings_of_nothing(spark):
    assert substring.remove_repeats(frame(spark, [])).count() == 0
    assert substring.cut_documents(frame(spark, [(1, None)])).collect()[0]["text"] is None
