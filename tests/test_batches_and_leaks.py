"""Predictions over true global batches; leaks found by digests, collisions of digests included."""

from pyspark.sql import functions as F

from qalam.operators import predict as PR
from qalam.operators import split as SP


def neighbours():
    """A model whose answer depends on the batch: its size, first text and the text's place. Made here, as
    workers can't import this file."""

    def factory():
        return lambda batch: [f" {t}|{batch[0]}|{len(batch)}|{i} " for i, t in enumerate(batch)]

    return factory


def test_batches_are_those_of_the_whole_table(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = [(i * 3, f"t{i}", i % 2) for i in range(500)]
    want = {f: f"{t}|t{i // 7 * 7}|{min(7, 500 - i // 7 * 7)}|{i % 7}" for i, (f, t, _) in enumerate(rows)}
    try:
        for partitions, arrow in ((1, 10_000), (5, 10), (13, 3)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow))
            df = spark.createDataFrame(rows, "row_id long, source_text string, v int").repartition(partitions, F.xxhash64("row_id"))
            got = PR.batch_predict(df, neighbours(), batch_size=7)
            assert got.columns == ["row_id", "source_text", "v", "prediction"]
            assert {r.row_id: r.prediction for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert PR.batch_predict(df.limit(0), neighbours()).collect() == []


def test_leaks(spark):
    rows = [(f"en{i % 50}", f"ar{i % 50}", "train" if i % 50 < 45 or i < 50 else "val") for i in range(150)]
    rows += [(None, "x", "train"), (None, "x", "test"), ("", "x", "train"), ("ab", "c", "train"), ("a", "bc", "val")]
    df = spark.createDataFrame(rows, "en string, ar string, split string")
    assert SP.leakage_check(df).first().leak_count == 6
    # all pairs on one digest, and on three of them: the texts decide
    for key in (F.lit(b"same"), F.substring(F.md5("ar"), 1, 1).cast("binary")):
        assert SP.leakage_check(df, key).first().leak_count == 6
    assert SP.leakage_check(df.where("split = 'train'")).first().leak_count == 0
    plan = SP.leakage_check(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in plan
