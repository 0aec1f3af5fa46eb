"""Row hashes by built-in expressions against those of pandas, bit by bit."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from qalam.functions import pairhash as P
from qalam.operators import split as SP
from qalam.plans import corpus as Q

SF001 = "/root/testdata/sf0.001"


def unsigned(x):
    return x & ((1 << 64) - 1)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    pool = "abcXYZ019 .,\n\x00éßمرحبا日本\U0001f600"
    return ["".join(rng.choices(pool, k=k)) for k in [*range(40), 100, 1000]] + ["", "a", "\x00" * 8, "x" * 40_000]


def test_string_hashes(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [unsigned(r.h) for r in df.select("i", P.mixed(P.siphash(F.col("t"))).alias("h")).orderBy("i").collect()]
    assert got == pd.util.hash_array(np.array(texts, dtype=object), categorize=False).tolist()


def test_row_hashes_and_shares(spark, texts):
    rows = pd.DataFrame({"en": texts, "ar": texts[::-1], "third": texts[5:] + texts[:5]}, dtype=object)
    df = spark.createDataFrame(list(rows.itertuples(name=None)), "i int, en string, ar string, third string")
    for columns in (["en"], ["en", "ar"], ["en", "ar", "third"]):
        want = pd.util.hash_pandas_object(rows[columns], index=False, categorize=False).astype("uint64")
        got = df.select("i", P.pair_hash(*columns).alias("h")).withColumn("u", P.unit_interval(F.col("h"))).orderBy("i").collect()
        assert [unsigned(r.h) for r in got] == want.tolist()
        assert [r.u for r in got] == (want / np.float64(2**64)).tolist()


def test_shares_of_extreme_numbers(spark):
    numbers = [0, 1, 2**53 + 1, 2**63 - 1, 2**63, 2**63 + 1, 2**63 + 1025, 2**64 - 1025, 2**64 - 1024, 2**64 - 1]
    df = spark.createDataFrame([(i, n - 2**64 if n >> 63 else n) for i, n in enumerate(numbers)], "i int, h long")
    got = [r.u for r in df.select("i", P.unit_interval(F.col("h")).alias("u")).orderBy("i").collect()]
    assert got == (np.array(numbers, np.uint64) / np.float64(2**64)).tolist()


def test_split_of_every_fixture_pair(spark):
    rows = Q.q_row_hash_split(spark, SF001).toPandas()
    u = pd.util.hash_pandas_object(rows[["en", "ar"]].astype(object), index=False).astype("uint64") / np.float64(2**64)
    assert rows["split"].tolist() == np.where(u < 0.9, "train", np.where(u < 0.95, "val", "test")).tolist()
    assert set(rows["split"]) == {"train", "val", "test"} and rows["row_id"].is_unique
    assert SP.leakage_check(spark.createDataFrame(rows)).first().leak_count == 0
    with pytest.raises(ValueError):
        SP.row_hash_split(spark.createDataFrame(rows), 0.9, 0.05, 0.06)


def test_row_hashes_run_on_whole_batches(spark):
    """Hashes of rows need no expression that is interpreted for each block of a text."""
    df = spark.createDataFrame([(1, "a", "b"), (2, None, "b"), (3, "a", None)], "row_id int, en string, ar string")
    split = SP.row_hash_split(df)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan
    hashes = {r.row_id: r.h for r in df.select("row_id", P.pair_hash("en", "ar").alias("h")).collect()}
    assert hashes[1] is not None and hashes[2] is None and hashes[3] is None
    assert split.where("row_id > 1 AND split = 'test'").count() == 2
