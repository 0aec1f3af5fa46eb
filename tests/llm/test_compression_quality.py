"""The compression classifier on held-out labels, its arithmetic by hand, and awkward tables."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard as zstd
from pyspark.sql import functions as F

from qalam.llm import compression_quality as CQ

SF01 = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return CQ.fit(CQ.training_sample(*tables))


def test_held_out_rows(tables, model):
    docs, labels = tables
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = CQ.score_texts(docs, model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.select("doc_id").collect())
    for r in rows:
        assert r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    judged = [(r.score, r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    good, bad = [h for h in judged if h[2]], [h for h in judged if not h[2]]
    wins = sum((g[0] > b[0]) + (g[0] == b[0]) / 2 for g in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.9
    assert sum(not g[1] for g in good) <= 0.03 * len(good)


def test_score_is_the_calibrated_size_difference_of_whole_texts(tables, model):
    """Every block of a text counts, the last as much as the first."""
    docs = tables[0].limit(60).unionByName(tables[0].orderBy(F.desc("n_chars")).limit(3))

    def size(text, dictionary):
        c = zstd.ZstdCompressor(level=CQ.LEVEL, dict_data=zstd.ZstdCompressionDict(dictionary))
        return sum(len(c.compress(text[i : i + CQ.BLOCK])) for i in range(0, len(text), CQ.BLOCK))

    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    for r in CQ.score_texts(docs, model).collect():
        text = texts[r.doc_id]
        x = (size(text, model.bad) - size(text, model.good)) / (len(text) + CQ.SOFT_BYTES)
        assert r.score == pytest.approx(1 / (1 + math.exp(-(model.slope * x + model.bias))))


def test_bad_tail_lowers_a_long_text(spark, tables, model):
    good = tables[0].join(tables[1], "doc_id").filter("quality = 1 AND n_chars > 4000").first().text
    bad = tables[0].join(tables[1], "doc_id").filter("quality = 0 AND n_chars > 2000").first().text
    probe = spark.createDataFrame([(1, good * 3), (2, good + bad * 8)], "doc_id long, text string")
    whole, tailed = [r.score for r in CQ.score_texts(probe, model).orderBy("doc_id").collect()]
    assert tailed < whole - 0.1


def test_sample_takes_no_held_out_row_and_is_bounded(spark, tables):
    docs, labels = tables
    sample = CQ.training_sample(docs.unionByName(docs), labels, rows=50)
    assert sample.count() == 50
    learned = {t for (t,) in CQ.training_sample(docs, labels).select("text").collect()}
    free = {r.text for r in docs.join(labels, "doc_id").collect() if not held(r.doc_id)}
    assert learned == free
    assert len(CQ.class_blocks(sample, True, limit=7)) == 7


def test_model_ignores_other_columns(tables, model):
    docs, labels = tables
    other = docs.withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string"), "score": F.lit("y")})
    again = CQ.fit(CQ.training_sample(other, labels.withColumn("text", F.lit("z"))))
    assert again == model


def test_calibration():
    x = np.array([-1.0] * 30 + [1.0] * 70)
    good = np.array([1.0] * 6 + [0.0] * 24 + [1.0] * 63 + [0.0] * 7)
    slope, bias = CQ.calibrated(x, good)
    for at, share in ((-1, 0.2), (1, 0.9)):
        assert 1 / (1 + math.exp(-(slope * at + bias))) == pytest.approx(share, abs=0.02)
    assert CQ.calibrated(-x, good)[0] == 0


def test_awkward(spark, awkward, empty, tables, model):
    labels = tables[1]
    got = CQ.compression_quality(awkward, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in awkward.collect())
    assert CQ.compression_quality(empty, labels).collect() == []
    assert CQ.compression_quality(awkward, labels.limit(0)).count() == awkward.count()
    by_id = {r.doc_id: r for r in CQ.score_texts(awkward, model).collect()}
    assert by_id[1].score == by_id[2].score == pytest.approx(1 / (1 + math.exp(-model.bias)))
    few = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (8, 0, 0), (9, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in CQ.compression_quality(awkward, few).collect())
