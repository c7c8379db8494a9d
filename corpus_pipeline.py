"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, documents, data directory) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents. All but the last return the columns of
documents. Labels of the data directory teach the quality classifier, languages of its documents
that held the stage's input teach language identification.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfunnel.llm import language, mixing, near_duplicates, packing, quality
from wayfunnel.llm.common import scratch, table
from wayfunnel.llm.queries import learnt_languages, learnt_quality, pack_tokens


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranker scores at least the threshold."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), learnt_quality())


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the learnt languages make up at least half, and background the rest."""
    return language.keep_known(docs, learnt_languages())


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.keep_one(docs, words=5)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources approach their target weights."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences with their places in windows of 4,096 ids."""
    return packing.pack_documents(docs, pack_tokens())


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("mixing", mixed),
    ("packing", packed),
]

# Learnt models and components of a graph are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, documents, sf_dir).write.parquet(path)
        documents = spark.read.parquet(path)
    return documents
