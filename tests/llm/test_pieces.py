"""Sampled segmentations: distribution, order, inclusion scores and round trips."""

import math
import time
from collections import Counter

import numpy as np
import pytest

from gaugeflow.llm import pieces

TEXTS = [
    "", " ", "a", "the cat", "  two  blanks ", "line\nends\n\nand\ttabs", "▁ literal ▁▁", "ünï çødé 漢字 😀", "nul\x00byte", "a" * 300,
    "Hello, world! It's 3.14; isn't it? x_.y ².", "word " * 400, "no-blanks-" * 200,
]


@pytest.fixture(scope="module")
def lattice():
    return pieces.Lattice(pieces.vocabulary(), 0.3)


def every(lattice, text):
    """All segmentations of a short text with their log-probabilities, by recursion over its pieces."""
    text, found = " " + text, {}

    def go(at, ids, weight):
        if at == len(text):
            found[tuple(ids)] = weight
        for end in range(at + 1, len(text) + 1):
            if (i := lattice.v.pieces.get(text[at:end])) is not None:
                go(end, [*ids, i], weight + lattice.weight[i])

    go(0, [], 0.0)
    total = math.log(sum(map(math.exp, found.values())))
    return {k: w - total for k, w in found.items()}


def test_probabilities_and_frequencies(lattice):
    true = every(lattice, "the cat")
    n = 4000
    got = pieces.search(["the cat"] * n, list(range(n)), lattice, 3)
    first = Counter(tuple(g[0][0].tolist()) for g in got)
    for g in got:
        assert len({x[0].tobytes() for x in g}) == 3
        assert g[0][2] >= g[1][2] >= g[2][2]
        for ids, p, _, _ in g:
            assert p == pytest.approx(true[tuple(ids.tolist())], abs=1e-4)
    for path, times in first.most_common(6):
        p = math.exp(true[path])
        assert abs(times / n - p) < 5 * math.sqrt(p * (1 - p) / n)
    # weighting by inclusion gives sums over all segmentations without bias
    weighted = [sum(math.exp(p - q) * len(ids) for ids, p, _, q in g) for g in got]
    mean = sum(math.exp(p) * len(ids) for ids, p in true.items())
    assert abs(np.mean(weighted) - mean) < 6 * np.std(weighted) / math.sqrt(n)


def test_long_texts_draw_the_same_distribution(lattice):
    """With many words left the rest is drawn at once: the first words still follow their probabilities."""
    true, n = every(lattice, "the"), 3000
    got = pieces.search(["the" + " of and to in is" * 12] * n, list(range(n)), lattice, 2)
    for at in (0, 1):
        first = Counter()
        for g in got:
            first[next(k for k in true if tuple(g[at][0][: len(k)].tolist()) == k and _ends(lattice, g[at][0], len(k)))] += 1
            assert pieces.decode_ids(g[at][0].tolist(), lattice.v.table).startswith("the of and")
        path, times = first.most_common(1)[0]
        p = math.exp(true[path])
        assert abs(times / n - p) < 6 * math.sqrt(p * (1 - p) / n)


def _ends(lattice, ids, n):
    return len(b"".join(lattice.v.table[i] for i in ids[:n].tolist())) == 4


def test_all_segmentations_when_there_are_few(lattice):
    true = every(lattice, "ab")
    got = pieces.search(["ab"], [1], lattice, 50)[0]
    assert {tuple(x[0].tolist()) for x in got} == set(true)
    assert all(x[3] == 0.0 for x in got)


def test_round_trips_rows_and_seeds(spark):
    rows = [*enumerate(TEXTS), (100, None), (3, "the cat"), (None, "nobody")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS sample", "2 AS ids")
    got = pieces.sample(df, k=2).collect()
    assert all(r["round_trip"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], {}).setdefault(r["sample"], set()).add(tuple(r["ids"]))
    assert by[0] == {1: {()}} and by[100] == {1: {()}}
    assert all(len(v) == 1 for v in by[3].values()) and len(by[3]) == 2
    assert all(by[i][1] != by[i][2] for i in by if i not in (0, 100) and len(by[i]) == 2)
    again = pieces.sample(df.repartition(3), k=2).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    back = pieces.decode(pieces.sample(df, k=1)).collect()
    texts = dict(rows)
    assert all(r["text"] == (texts[r["doc_id"]] or "") for r in back)
    assert pieces.sample(df.where("false")).count() == 0


def test_ids_decode_with_the_library_too(lattice):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for text in TEXTS:
        if "▁" not in text and "\x00" not in text:
            for ids, *_ in pieces.search([text], [7], lattice, 3)[0]:
                assert sp.decode(ids.tolist()) == text


def test_long_words_follow_the_same_probabilities(lattice, monkeypatch):
    """With ``LONG`` at two characters every word counts as long: sums and draws stay those of the lattice."""
    monkeypatch.setattr(pieces, "LONG", 2)
    short = pieces.Lattice(lattice.v, 0.3)
    true, n = every(lattice, "thecat"), 4000
    got = pieces.search(["thecat"] * n, list(range(n)), short, 3)
    first = Counter(tuple(g[0][0].tolist()) for g in got)
    for g in got:
        assert len({x[0].tobytes() for x in g}) == 3
        assert all(p == pytest.approx(true[tuple(ids.tolist())], abs=1e-4) for ids, p, _, _ in g)
    for path, times in first.most_common(6):
        p = math.exp(true[path])
        assert abs(times / n - p) < 5 * math.sqrt(p * (1 - p) / n)


def test_a_million_characters_without_a_blank(lattice):
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefghiklmnoprstuwyz"), 1_000_000))
    begun = time.process_time()
    got = pieces.search([text], [7], pieces.Lattice(lattice.v, 0.3), 2)[0]
    assert time.process_time() - begun < 20  # 6 s on an idle machine, quadratic work takes minutes
    assert all(pieces.decode_ids(ids.tolist(), lattice.v.table) == text for ids, *_ in got)
    # where a word stands, and with which others, changes nothing
    again = pieces.search(["some words", text[:5000], "a"], [1, 7, 2], lattice, 2)[1]
    alone = pieces.search([text[:5000]], [7], pieces.Lattice(lattice.v, 0.3), 2)[0]
    assert [x[0].tolist() for x in again] == [x[0].tolist() for x in alone]
