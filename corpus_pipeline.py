"""Corpus pipeline: five training-data stages over ``documents``.

Each stage works on all rows that its predecessor kept and returns the columns of
documents; the last returns what the mix takes of each document. The near-duplicate
stage keeps the contract of the SimHash operator (three-word shingles, two bits).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyweft.llm import decontam, langid, mixing, quality, simhash
from skyweft.llm.common import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF, fitted on this stage's rows, accepts."""
    return quality.keep_good(docs, quality.trained(docs, table(spark, sf_dir, "labels")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return langid.keep_known(docs, langid.trained(docs))


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest id."""
    return simhash.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; mostly contaminated ones go whole."""
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of each document."""
    return mixing.taken(mixing.mix(docs))


STAGES = [
    ("quality_classifier", good_quality),
    ("language_id", known_language),
    ("simhash_near_dedup", near_deduplicated),
    ("benchmark_decontamination", decontaminated),
    ("source_mixing", mixed),
]

#: The classifiers are trained, so no SQL makes these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
