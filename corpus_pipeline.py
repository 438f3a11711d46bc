"""The corpus pipeline: five operators in a row, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobmill.llm import apportion, exact_dedup, near_dedup, packing, weak_quality
from jobmill.llm.common import store, table

# Stages learn from the corpus or use a tokenizer, so no SQL has their rows.
ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return weak_quality.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of the sources; a document may come twice."""
    return apportion.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in a training sequence."""
    return packing.pack(docs)


STAGES = [("quality", good), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs, f"stage-{name}")
    return docs
