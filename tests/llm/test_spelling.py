"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import spelling
from gaugeflow.llm.spelling import Numbering, Settings


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, factor=5):
    form, out = {}, []
    around = {w: [v for v in counts if near(w, v)] for w in counts}
    for w, vs in around.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(around[w]), counts.get(form[w])))
    return sorted(out)


def grouped(spark, counts, **settings):
    frame = spark.createDataFrame([*counts.items(), (None, 9)], "word string, n int").withColumns({"form": F.lit("mine"), "id": F.lit(0)})
    return sorted(tuple(r) for r in spelling.group(frame.repartition(3), Settings(**settings)).collect())


@pytest.mark.parametrize("sample", [1, 2, 50])
def test_groups_match_brute_force(spark, sample):
    rng = random.Random(sample)
    counts = {}
    for _ in range(700):
        counts["".join(rng.choice("abü") for _ in range(rng.randint(1, 9)))] = rng.choice([1, 5, 5, 25, 30, 125, 700])
    counts |= {"a" * 60: 5, "a" * 61: 30, "a" * 62: 200, "🙂aaa": 3, "🙂aaaa": 20, "é": 1}
    assert grouped(spark, counts, sample=sample) == brute(counts)


def test_a_letter_apart_at_every_place_and_long_words(spark):
    alphabet = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    counts = {f"spel{c}ing": 5 + i for i, c in enumerate(alphabet)} | {f"{c}speling": 900 for c in alphabet} | {"speling": 30}
    long = "xy" * 50_000
    counts |= {long: 100, long + "z": 5, long[:-1] + "z": 6, long[:7] + "q" + long[7:]: 7}
    assert grouped(spark, counts) == brute(counts)


def test_chains_of_forms_lead_to_one_root(spark):
    counts = {"a" * k: 5**k for k in range(1, 14)}
    assert {r[2] for r in grouped(spark, counts)} == {"a" * 13}


def test_numbers_are_those_of_prefixes():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(400)})
    for borders in ([], words[5:6], words[::40], words[::3], ["", "ab", "zz"]):
        trie, at = Numbering(borders), {}
        for w in words:
            path = trie.nodes(w)
            assert len(path) == len(w) + 1
            for k, number in enumerate(path):
                assert at.setdefault(number, w[:k]) == w[:k]
        assert len(at) == len({w[:k] for w in words for k in range(len(w) + 1)})


def test_variants_of_texts(spark):
    rng = random.Random(9)
    words = ["Straße", "letters", "Letters", "naïveté", "abcdefg", "short", "ÉTUDESX", "estion"]
    docs = [(i, rng.choice(["", "1"]).join(rng.choice([" ", "-", "9", "Ā"]).join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(3))) for i in range(80)]
    docs += [(None, "letters " * 7), (200, None), (201, ""), (1, docs[1][1]), (202, "letter " * 20_000 + "y" * 70_000), (203, "123 !?")]
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 7 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"word": F.lit("mine"), "n": F.lit(1), "id": F.lit(2)})
    got = spelling.variants(frame, damage=7)
    assert sorted(tuple(r) for r in got.collect()) == brute(counts) and len(counts) > 8


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id bigint, text string")
    assert spelling.variants(docs).count() == 0 and spelling.variants(docs.where("false")).count() == 0
