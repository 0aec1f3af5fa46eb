"""Small frames with the awkward cases, and frames of the given tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"

LONG = "lorem ipsum dolor sit amet " * 4000

AWKWARD = [
    (1, None, "en", "a"),
    (2, "", "en", "b"),
    (3, "   \n\t ", None, None),
    (4, LONG, "en", "a"),
    (5, "the same text of some few words", "en", "a"),
    (6, "the same text of some few words", "en", "b"),
    (6, "the same text of some few words", "en", "b"),
    (7, "Ünïcode – words, 日本語 \U0001f600 and\u00a0more; nul\x00l <|endoftext|> </s> ▁", "de", "c"),
    (8, "a", "en", "a"),
    (None, "a row without an id, CC BY 4.0 and all rights reserved", "en", "d"),
    (9, "line one of it\nline two of it\nline one of it\r\n\n", "en", "e"),
]

#: Columns that operators might use inside.
CLASHING = ["key", "row", "words", "lines", "n", "kept", "at", "site", "lost", "band", "code", "tie", "ids", "score", "host"]


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string")
    return docs.withColumn("n_chars", F.length("text").cast("long")).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from qalam.session import ship_package

    ship_package(spark)
