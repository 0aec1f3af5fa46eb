"""Corpus pipeline: documents -> toxicity -> quality rules -> line dedup -> near dedup -> packing.

Each stage is one of the training-data operators. Its result is written as Parquet under the shared
checkpoint folder and read again as the next stage's documents, so a lost executor repeats a stage at
most. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from qalam.llm.line_dedup import without_boilerplate
from qalam.llm.near_dedup import one_of_each_class
from qalam.llm.packing import pack
from qalam.llm.quality_rules import with_quality
from qalam.llm.queries import WORD_TOKENIZER
from qalam.llm.tables import read_table, stage
from qalam.llm.toxicity import without_toxic
from qalam.session import ship_package

#: Documents that are so similar count as one site of the lines they share: near copies, and copies that
#: differ in a line or two of twenty, which near dedup may leave apart.
COPY_SIMILARITY = 0.7

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels of ``docs``, doesn't call toxic."""
    ship_package(spark)
    return without_toxic(docs, read_table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return with_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many sites share. Copies of a text count as one site, so that
    what they have in common stays, in one of them at least."""
    ship_package(spark)
    return without_boilerplate(docs, evidence=one_of_each_class(docs, COPY_SIMILARITY))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    ship_package(spark)
    return one_of_each_class(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of all documents."""
    ship_package(spark)
    return pack(docs, public_tokenizers.path(WORD_TOKENIZER), end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: No SQL: the classifier, the sampled signatures and the tokenizer have none; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
