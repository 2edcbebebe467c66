"""A training corpus from ``documents``: five stages, each on all that the one before it kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns documents with the columns it was given; the last returns the packed
pieces. Between stages the documents are written as Parquet to the shared folder and read again, so a lost executor repeats
work of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fellwalk.llm import op2_personal_data, op3_near_dedup, op4_mixing, op6_language, op9_packing
from fellwalk.llm.common import documents, settle_llm
from fellwalk.llm.queries import vocabulary
from fellwalk.workspace import settled


SIMILAR = (80, 100)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without one language for most of their words, go."""
    return op6_language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays; four fifths of their shingles make documents alike."""
    settle_llm(spark)
    return op3_near_dedup.deduplicate(docs, SIMILAR)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in every text."""
    return op2_personal_data.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their targets by taking documents never, once or twice."""
    return op4_mixing.mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in sequences of equal length."""
    settle_llm(spark)
    return op9_packing.pack(docs, vocabulary())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

# Language models, MinHash and hash-seeded copies are not SQL's to compute; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order on the documents of ``sf_dir``."""
    docs = documents(settle_llm(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
