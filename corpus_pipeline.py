"""A training corpus from the documents: filtered, freed of duplicates, packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
A stage keeps every row that its operator doesn't reject; see the operators for nulls,
empty texts, ties and repeated rows. An empty table passes through as an empty table.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from formlake.llm.exact_dedup import drop_exact_duplicates
from formlake.llm.packing import pack_documents
from formlake.llm.quality import drop_low_quality
from formlake.llm.simhash import drop_near_duplicates
from formlake.llm.toxicity import drop_toxic
from formlake.llm.workers import share_package
from formlake.llm.written import written


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _stage(function):
    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        share_package(spark)
        return function(spark, docs, sf_dir)

    return run_stage


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    return drop_toxic(docs, _labels(spark, sf_dir), folds=4, fold=2)


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as of low quality go."""
    return drop_low_quality(docs, _labels(spark, sf_dir), folds=5, fold=0)


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the longest stays."""
    return drop_exact_duplicates(docs)


@_stage
def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id stays."""
    return drop_near_duplicates(docs, words=4, reach=4)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of what is left in sequences of 2,048 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0, added_tokens=True)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("packing", packing),
]

#: Classifiers and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
