"""Toxicity and licence scans."""

import math
import random
import re
import textwrap
import time
import zlib
from collections import Counter

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from gaugeflow.llm import licenses, toxicity


def test_held_out_accuracy(spark):
    sf = SF_DIR.replace("sf0.01", "sf0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r["doc_id"]: r for r in toxicity.classify(docs, labels).collect()}
    right = wrong = missed = 0
    for r in labels.collect():
        g = got[r["doc_id"]]
        assert g["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.7)
        if g["held_out"] and r["toxic"] is not None:
            right += r["toxic"] == g["predicted"] == 1
            wrong += r["toxic"] == 0 and g["predicted"] == 1
            missed += r["toxic"] == 1 and g["predicted"] == 0
    assert right / (right + missed) >= 0.85 and right / (right + wrong) >= 0.95


@pytest.fixture(scope="module")
def biased(spark):
    """Toxic texts mention one group more often than others do."""
    rng = random.Random(1)
    words = [f"{c}{v}{d}o" for c in "bdfgklm" for v in "aeiou" for d in "nprst"]
    rows = []
    for i in range(1500):
        toxic = i % 3 == 0
        text = [rng.choice(words) for _ in range(15)]
        group = "muslims" if rng.random() < (0.7 if toxic else 0.1) else rng.choice(["christians", "jews", "hindus", "people"])
        text.insert(rng.randrange(15), group)
        if toxic:
            text.insert(rng.randrange(15), rng.choice(["dreckig", "dreckiger", "abschaum", "widerlich"]))
        rows.append((i, " ".join(text) + ".", int(toxic)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    return df.select("doc_id", "text", F.lit("x").alias("score"), F.lit(1).alias("y")), df.select("doc_id", "toxic")


def test_counterfactual_term_evens_out_groups(biased):
    docs, labels = biased

    def gap(weight):
        score = toxicity.fit(docs, labels, settings=toxicity.Settings(counterfactual=weight)).scorer()
        said = [score(f"the {g} met banano and bapato today.") for g in ("muslims", "christians", "jews", "hindus")]
        return max(said) - min(said), max(said), score("banano dreckiger bapato.")

    plain, even = gap(0.0), gap(20.0)
    assert even[0] < 0.35 * plain[0]
    assert even[1] < 0.7 < even[2]


def test_labels_of_held_out_rows_are_not_learned(biased):
    docs, labels = biased
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.classify(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_odd_rows_and_missing_labels(spark, biased):
    docs, labels = biased
    odd = spark.createDataFrame([(None, "abschaum", "", 1), (2000, None, "", 1), (2001, "", "", 1), (2002, "abschaum " * 90_000, "", 1), (0, "x", "", 1)], docs.schema)
    null = spark.createDataFrame([(2000, None), (None, 1), (77777, 1)], "doc_id bigint, toxic int")
    got = toxicity.classify(docs.unionAll(odd), labels.unionAll(null)).collect()
    assert len(got) == 1505
    by = {r["doc_id"]: r for r in got}
    assert by[2000]["score"] == by[2001]["score"] < 0.5 < 0.7 <= by[2002]["score"]
    assert by[None]["held_out"] is False
    for some in (labels.where("false"), labels.where("toxic = 0")):
        assert {r["predicted"] for r in toxicity.classify(docs, some).collect()} == {0}
    assert toxicity.classify(docs.where("false"), labels).count() == 0


def test_keep_clean_keeps_columns(biased):
    docs, labels = biased
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    gone = {r["doc_id"] for r in toxicity.classify(docs, labels).collect() if r["predicted"]}
    assert {r["doc_id"] for r in kept.collect()} == set(range(1500)) - gone and len(gone) > 300


def test_long_texts_are_read_whole():
    assert "needle" in toxicity.words_of("word " * 500_000 + "NEEDLE")


MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
PROSE = "the cat sat under the mat and the version of the story was general and public\n"


def test_headers_files_and_inheritance(spark):
    rows = [
        (1, "a/LICENSE", MIT), (2, "a/b/x.txt", PROSE), (3, "a/b/c/y.txt", PROSE + APACHE + "\n" + PROSE * 9), (4, "a/b/c/z.txt", PROSE),
        (5, "top.txt", PROSE), (6, "d/notice.md", f"{APACHE}\n"), (7, "d/e/f/g.txt", ""), (8, "ab/x.txt", PROSE), (9, None, None),
        (10, "h/one", MIT), (11, "h/two", PROSE), (None, "d/n.txt", PROSE), (12, "a/b/q", PROSE), (12, "a/b/q", PROSE), (13, "d/long", PROSE * 5000 + MIT),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, path string, text string").withColumns({"key": F.lit(1), "line": F.lit(2)})
    got = licenses.scan(df, "doc_id", F.col("path")).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["license"], r["origin"]) for r in got}
    assert by[1] == ("MIT", "a/LICENSE") and by[2] == ("MIT", "a") and by[3] == ("Apache-2.0", "a/b/c/y.txt")
    assert by[4] == ("MIT", "a") and by[5] == (None, None) and by[6] == ("Apache-2.0", "d/notice.md")
    assert by[7] == ("Apache-2.0", "d") == by[None] and by[8] == (None, None) == by[9]
    assert by[10] == ("MIT", "h/one") and by[11] == ("MIT", "h") and by[12] == ("MIT", "a") and by[13] == ("MIT", "d/long")
    assert licenses.scan(df.where("false"), "doc_id", F.col("path")).count() == 0


def test_document_frequencies_of_all_terms(spark):
    """A notice with an ordinary word counts, however large the corpus; brute force over all terms."""
    notice = "The project is released under the MIT License."
    rows = [(0, "a/x", f"{PROSE}\n{notice}\n"), *[(i, f"b/{i}", f"the project of day {i} under way") for i in range(1, 400)]]
    df = spark.createDataFrame(rows, "doc_id bigint, path string, text string")
    terms = lambda text: re.findall("[a-z0-9]+", text.lower())
    held = Counter(t for _, _, text in rows for t in set(terms(text)))
    vector = lambda text: {t: k * (math.log((1 + len(rows)) / (1 + held[t])) + 1) for t, k in Counter(terms(text)).items()}
    a, b = vector(notice), vector(MIT)
    cosine = sum(a[t] * b.get(t, 0) for t in a) / math.hypot(*a.values()) / math.hypot(*b.values())
    got = {r["doc_id"]: (r["license"], r["score"]) for r in licenses.scan(df, "doc_id", F.col("path")).collect()}
    assert got[0] == ("MIT", pytest.approx(cosine, abs=1e-6)) and cosine >= 0.75
    assert {v for k, v in got.items() if k} == {(None, None)}


GPL = (" This program is free software{0} you can redistribute it and/or modify\n it under the terms of the GNU General Public License as published by\n"
       " the Free Software Foundation{1} either version {2} of the License, or\n (at your option) any later version.")  # fmt: skip


def test_wrapped_notices_and_licence_files(spark):
    wrap = lambda text, width=70: "\n".join(textwrap.wrap(text, width))
    marked = lambda text, mark: "\n".join(f"{mark}{x}" for x in text.split("\n"))
    mit = f"MIT License\n\nCopyright (c) 2020 A B\n\n{wrap(licenses._MIT)}\n\n{wrap(licenses._MIT_REST)}\n"
    bsd = "\n\n".join(wrap(x) for x in ("Copyright 2020 A B. All rights reserved.", licenses._BSD_2, licenses._BSD_3, licenses._BSD_REST))
    code = "import os\nimport sys\n" + PROSE * 30
    rows = [
        (1, "a/x.py", f"{marked(GPL.format(':', ',', 3), '#')}\n{code}"), (2, "b/x.c", f"/*\n *{PROSE} *\n{marked(GPL.format(';', ';', 2), ' *')}\n */\n{code}"),
        (3, "c/LICENSE", mit), (4, "c/d/x", PROSE), (5, "e/x.c", f"/*\n{marked(bsd, ' * ')}\n */\n{code}"), (6, "f/COPYING", bsd), (7, "f/x", PROSE),
        (8, "g/x", " ".join(GPL.format(";", ";", 2).split())), (9, "h/x.c", f"/* {bsd} */\n{code}"), (10, "i/x", PROSE.replace(" ", "\n")),
        (12, "k/COPYING", f"Statement of Purpose\n\n{wrap(licenses._CC0)}\n\n{PROSE * 20}"),
        (13, "l/LICENSE", f"{PROSE}\n\n{wrap(licenses._CC.format('Attribution-ShareAlike'))}\n\n{PROSE * 20}"),
        (11, "j/LICENSE", f"GNU GENERAL PUBLIC LICENSE\n\n{PROSE * 20}\n\n{GPL.format(':', ',', 3)}\n\n{PROSE}"),
    ]
    got = {r["doc_id"]: (r["license"], r["origin"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, path string, text string"), "doc_id", F.col("path")).collect()}
    assert got[1] == ("GPL-3.0", "a/x.py") and got[2] == ("GPL-2.0", "b/x.c") and got[3] == ("MIT", "c/LICENSE") and got[4] == ("MIT", "c")
    assert got[5] == ("BSD-3-Clause", "e/x.c") and got[6] == ("BSD-3-Clause", "f/COPYING") and got[7] == ("BSD-3-Clause", "f")
    assert got[8] == ("GPL-2.0", "g/x") and got[9] == ("BSD-3-Clause", "h/x.c") and got[10] == (None, None) and got[11] == ("GPL-3.0", "j/LICENSE")
    assert got[12] == ("CC0-1.0", "k/COPYING") and got[13] == ("CC-BY-SA-4.0", "l/LICENSE")


def test_nearest_directory_wins_and_the_root_counts(spark):
    rows = [(1, "LICENSE", MIT), (2, "a/COPYING", APACHE), (3, "a/b/x", PROSE), (4, "c/x", PROSE), (5, "a/LICENCE.txt", "Licensed under the ISC License.")]
    got = {r["doc_id"]: (r["license"], r["origin"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, path string, text string"), "doc_id", F.col("path")).collect()}
    # two files in one directory match fully: the smaller path counts
    assert got[3] == ("Apache-2.0", "a") and got[4] == ("MIT", "")


def test_the_prefilter_loses_nothing():
    weight = {t: 1.0 + i % 5 for i, t in enumerate(sorted({t for c in licenses.counts() for t in c}))}
    heavy = licenses.heavy_terms(weight, 0.75)
    for terms in licenses.counts():
        light = {t: n * weight[t] for t, n in terms.items() if t not in heavy}
        whole = sum((n * weight[t]) ** 2 for t, n in terms.items()) ** 0.5
        # the light terms alone are the best text without a heavy term
        assert sum(v * v for v in light.values()) ** 0.5 / whole < 0.75


def test_many_lines_take_linear_time(spark):
    lines = [f"value {i} of the list" if i % 7 else "" for i in range(400_000)]
    lines[200_000:200_000] = ["", *GPL.format(":", ",", 3).split("\n"), ""]
    df = spark.createDataFrame([(1, "a/LICENSE", "\n".join(lines)), (2, "a/x", PROSE)], "doc_id bigint, path string, text string")
    begun = time.monotonic()
    got = {r["doc_id"]: r["license"] for r in licenses.scan(df, "doc_id", F.col("path")).collect()}
    taken = time.monotonic() - begun
    assert got == {1: "GPL-3.0", 2: "GPL-3.0"}
    assert taken < 60, taken  # 400,000 lines; work that grew with their square took over an hour
