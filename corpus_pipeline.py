"""The corpus pipeline: each stage reads what the one before it kept, written as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm import mixing, pieces, simhash, substring, toxicity
from gaugeflow.llm.common import stored


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under its threshold."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return simhash.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the words of passages that also start earlier."""
    return substring.cut_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a document at most three times."""
    return mixing.mix_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two segmentations of each document of the mix."""
    return pieces.sample(docs)


STAGES = [
    ("toxicity", clean),
    ("simhash", near_duplicates),
    ("substring", passages),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]
ORACLE_SQL = None  # hashes of shingles, draws and the classifier aren't expressible


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs, _ = stored(docs, f"pipeline-{name}")
    return docs
