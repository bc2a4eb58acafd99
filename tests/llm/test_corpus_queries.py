"""The registered queries, and the pipeline."""

import pytest
from conftest import SF_DIR
from oracle import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from gaugeflow.llm import simhash, substring
from gaugeflow.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF_DIR), QUERIES[name], SF_DIR) == []


def test_pipeline_stages(spark, tmp_path):
    sf = SF_DIR
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, out = docs, stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        ids = {r["doc_id"] for r in docs.select("doc_id").distinct().collect()}
        there = {r["doc_id"] for r in before.select("doc_id").distinct().collect()}
        assert ids <= there
        if at + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
        if name == "toxicity":
            toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").collect()}
            clean = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 0").collect()}
            assert len(toxic & ids) < 0.5 * len(toxic) and len(clean & there - ids) <= 0.01 * len(clean)
        elif name == "simhash":
            least = {r["component_id"] for r in simhash.near_duplicates(before).collect()}
            assert ids == least and docs.count() == len(least)
        elif name == "substring":
            assert docs.count() == before.count()
            left = substring.remove_repeats(docs).agg(F.sum("n_words")).first()[0]
            assert left == substring.remove_repeats(before).agg(F.sum(F.col("n_words") - F.col("n_removed"))).first()[0]
        elif name == "mixing":
            assert docs.where("text = ''").count() == 0
        else:
            assert docs.where("NOT round_trip").count() == 0 and ids == there


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a b", None, None, 3), (2, "a b", None, None, 3), (3, "x" * 100_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    clash = ["ids", "__id", "__n", "__mine", "__words", "__starts", "__toxicity", "__text", "__digest", "n_words", "toxicity", "c0", "c1", "digest", "row", "id", "starts", "n", "a b`c"]
    docs = docs.withColumns({c: F.lit(f"my {c}") for c in clash})
    for some in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            some = stage(spark, some, SF_DIR)
            if name == "sentencepiece":
                some.count()
                continue
            assert some.columns == docs.columns
            assert all(r[c] == f"my {c}" for r in some.collect() for c in clash)
