"""A corpus cleaning pipeline: stages over ``documents``, each written and reread.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir),
where docs is what the stage before it kept, and returns a DataFrame; all but
the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftline.llm import bpe, language, mixing, near, quality, queries
from shiftline.llm.common import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, predicts good."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.keep_known(docs)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply_mix(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every remaining document's token ids and of the text they decode to."""
    return bpe.digests(docs, queries.BYTE_BPE)


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", distinct_texts),
    ("mixing", mixed_sources),
    ("bpe", encode_bpe),
]

# The learned and hashed stages cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
