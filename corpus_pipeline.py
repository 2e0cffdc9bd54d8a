"""The corpus pipeline: five operators in a row, each over all that the one before it kept.

Defined results: rows with null ids, texts or sources pass like any others; an empty table gives an empty one with
the same columns; columns beyond those of ``documents``, whatever their names, are handed on by all stages but
the last. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.llm import exact_dedup, lsh_forest, mixing, pieces, quality
from citygrain.llm.queries import quality_weights
from citygrain.llm.registry import table
from citygrain.session import prepare, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents that score below this are rejected.
LEAST_QUALITY = 0.7


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is high enough, judged on whole texts.

    A null or empty text has a score too; without labels every score is 0.5, so nothing stays.
    """
    prepare(spark)
    model = quality.fit_quality_model(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return quality.keep_good(docs, model, LEAST_QUALITY)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest id; null and empty texts are equal."""
    prepare(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the smallest id; null and empty texts are one class."""
    prepare(spark)
    return lsh_forest.drop_similar_documents(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; texts without words are in no mix, a null source is one."""
    prepare(spark)
    return mixing.mixed_documents(docs, quality_weights(table(spark, sf_dir, "labels")))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, repeats included; a text without any has none."""
    prepare(spark)
    return pieces.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", dissimilar_documents),
    ("mixing", mixed_documents),
    ("sentencepiece", encoded_documents),
]

#: A learned score, a banded search and merged pieces are beyond SQL; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
