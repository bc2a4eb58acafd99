"""Benchmark decontamination against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import contamination
from gaugeflow.llm.contamination import Settings

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, width=10):
    windows = []
    for item, text in items:
        ws = WORD.findall(lower(text))
        n = min(width, len(ws))
        windows += [(item, tuple(ws[i : i + n])) for i in range(len(ws) - n + 1) if n]
    out = []
    for i, text in docs:
        ms = list(WORD.finditer(lower(text)))
        ws, hit, found = [m.group() for m in ms], set(), set()
        for item, window in windows:
            for a in range(len(ws) - len(window) + 1):
                if tuple(ws[a : a + len(window)]) == window:
                    hit |= set(range(a, a + len(window)))
                    found |= {item} - {None}
        spans = []
        for k in sorted(hit):
            if spans and spans[-1][2] == k - 1:
                spans[-1][1:] = [ms[k].end(), k]
            else:
                spans.append([ms[k].start(), ms[k].end(), k])
        out.append((i, text, len(ws), len(hit), tuple((a, b) for a, b, _ in spans), tuple(sorted(found))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)] + ["ÄÖ", "ß", "naïve", "日本", "Ab", "7"]
    passage = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    gaps = [" ", "  ", "\n", ", ", "-", "_", "\x00", "...\t"]
    text = lambda ws: "".join(rng.choice([w, w.upper() if w.isascii() else w]) + rng.choice(gaps) for w in ws)
    items = [passage(rng.choice([1, 3, 9, 10, 11, 30])) if k else ["only", "Once"] for k in range(25)]
    docs = []
    for i in range(60):
        ws = passage(rng.randint(0, 40))
        if rng.random() < 0.6:
            item = rng.choice(items)
            a = rng.randint(0, max(0, len(item) - 10))
            ws[5:5] = item[a : a + rng.choice([9, 10, 14])]
        docs.append((i, text(ws)))
    some = [(k, text(item)) for k, item in enumerate(items)]
    some += [(3, "a second text of the same item that stands nowhere else"), (None, "no id but ten words or more to be hit by"), (77, None), (78, ""), (79, "?!")]
    docs += [(100, None), (101, ""), (102, " \n!"), (1, docs[1][1]), (None, docs[2][1]), (103, "z " * 30000 + " ".join(items[5]) + " z" * 30000)]
    docs += [(104, "So: no id, but ten words or MORE to be hit by. Fine"), (105, "xOnly Once"), (106, "🙂 é only-once 🙂"), (107, "only  ONCE only once")]
    return docs, some


@pytest.mark.parametrize("settings", [Settings(), Settings(piece=12, block=40), Settings(width=3, piece=3, block=1)])
def test_contamination_matches_brute_force(spark, corpus, settings):
    docs, items = corpus
    if settings.block == 1:  # a round for every piece
        docs, items = docs[:12] + docs[-5:], items[-5:] + items[:2]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    frame = frame.withColumns({"n_hit": F.lit("mine"), "runs": F.lit(1), "t": F.lit("t"), "c0": F.lit("c")})
    got = contamination.scan(frame, spark.createDataFrame(items, "item_id bigint, text string"), settings=settings)
    assert got.columns == ["doc_id", "text", "runs", "t", "c0", "n_words", "n_hit", "spans", "items"]
    found = [
        (r["doc_id"], r["text"], r["n_words"], r["n_hit"], tuple((s["start"], s["end"]) for s in r["spans"]), tuple(sorted(r["items"])))
        for r in got.collect()
    ]
    assert sorted(found, key=repr) == brute(docs, items, settings.width)


def test_spans_are_places_in_the_original(spark):
    docs = spark.createDataFrame([(1, "é 🙂 Before: ALPHA,beta\nGamma! after")], "doc_id bigint, text string")
    got = contamination.scan(docs, spark.createDataFrame([("x", "alpha beta gamma")], "item_id string, text string")).first()
    (span,) = got["spans"]
    assert got["text"][span["start"] : span["end"]] == "ALPHA,beta\nGamma" and got["items"] == ["x"]


def test_nothing_to_scan_or_to_find(spark, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id bigint, text string")
    items = spark.createDataFrame(corpus[1], "item_id bigint, text string")
    assert contamination.scan(docs.where("false"), items).count() == 0
    none = contamination.scan(docs, items.where("false"))
    assert none.count() == len(corpus[0]) and none.where("n_hit > 0 OR size(items) > 0 OR size(spans) > 0").count() == 0


def test_keep_clean(spark, corpus):
    docs, items = corpus
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("items", F.lit("mine"))
    kept = contamination.keep_clean(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    assert kept.columns == frame.columns
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(repr(r[:2]) for r in brute(docs, items) if not r[3])
