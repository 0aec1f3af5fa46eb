"""Inputs off the happy path: columns in another order, missing and repeated keys, null runs, sources
without ids, many partitions, empty sources and splits."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from qalam.operators import runlog as L
from qalam.operators import score as SC
from qalam.operators import split as SP
from qalam.plans import pipeline as PL
from qalam.sources import readers as R


def test_logs_and_pairs_are_read_by_name(spark, tmp_path):
    (tmp_path / "log.csv").write_text("val_loss,extra,step\n2.5,x,40\nbad,y,80\n")
    schema = Ty.StructType.fromDDL("step long, val_loss double, bleu double")
    got = [tuple(r) for r in R.read_metric_log(spark, str(tmp_path / "log.csv"), schema).orderBy("step").collect()]
    assert got == [(40, 2.5, None), (80, None, None)]
    (tmp_path / "pairs.csv").write_text('ar,en\n"مر","a ""b"",\nc"\nNA,x\n')
    pairs = R.read_pairs_csv(spark, str(tmp_path / "pairs.csv"), schema="en string, ar string").collect()
    assert {tuple(r) for r in pairs} == {('a "b",\nc', "مر"), ("x", None)}


def test_alignment_needs_every_key_once(spark):
    refs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "row_id long, target_text string")
    preds = spark.createDataFrame([(3, "z"), (1, "x"), (2, "y")], "row_id long, prediction string")
    assert sorted(tuple(r) for r in SC.align_predictions(refs, preds).collect()) == [(1, "a", "x"), (2, "b", "y"), (3, "c", "z")]
    for bad in (preds.limit(2), preds.unionByName(preds.limit(1)), preds.withColumn("row_id", F.col("row_id") + 1)):
        with pytest.raises(ValueError, match="row_id"):
            SC.align_predictions(refs, bad)


def test_null_runs_are_a_run(spark):
    log = spark.createDataFrame([(None, 1, 3.0), (None, 2, 2.0), (None, 3, 5.0), (7, 1, 1.0)], "run_id long, step long, val_loss double")
    best = {(r.run_id, r.step): r.is_best for r in L.running_best(log, "val_loss").collect()}
    assert best == {(None, 1): True, (None, 2): True, (None, 3): False, (7, 1): True}
    kept = {(r.run_id, r.step): r.keep for r in L.retain_last_n(log, 2).collect()}
    assert kept == {(None, 1): False, (None, 2): True, (None, 3): True, (7, 1): True}
    points = {(r.run_id, r.metric): (r.step, r.value) for r in L.best_points(log).collect()}
    assert points == {(None, "val_loss"): (2, 2.0), (7, "val_loss"): (1, 1.0)}


def test_best_points_tie_goes_to_the_first_step(spark):
    log = spark.createDataFrame([(1, 30, 4.0), (1, 10, 4.0), (1, 20, 1.0)], "run_id long, step long, bleu double")
    assert [tuple(r) for r in L.best_points(log).collect()] == [(1, "bleu", 10, 4.0)]


def test_best_points_and_leakage_use_hash_aggregates(spark):
    log = spark.createDataFrame([(1, 1, 1.0, 2.0)], "run_id long, step long, val_loss double, bleu double")
    plan = L.best_points(log)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_intervals_run_from_log_to_log(spark):
    """One micro-step a second: steps 2 to 40 of 32 micro-steps take 1,248 seconds."""
    rows = spark.range(32 * 80).select(
        F.lit(1).alias("run_id"), F.col("id").alias("micro"), F.timestamp_seconds(F.col("id")).alias("ts"), F.lit(1.0).alias("loss")
    )
    got = {r.interval_end: (r.steps, r.seconds) for r in L.interval_metrics(rows).collect()}
    assert got == {1: (1, 31.0), 40: (39, 1248.0), 80: (40, 1280.0)}


def test_run_ids_and_iso_text(spark):
    row = spark.sql("SELECT timestamp'2026-02-18 00:35:16' AS a, timestamp'2026-02-18 00:35:16.0102' AS b")
    assert row.select(L.run_id_of("a")).first()[0] == "20260218_003516"
    assert [row.select(L.iso_text(c)).first()[0] for c in "ab"] == ["2026-02-18T00:35:16", "2026-02-18T00:35:16.010200"]


def test_ids_of_sources_without_ids(spark):
    pairs = spark.range(260).select(F.concat(F.lit("e"), F.col("id") % 200).alias("en"), F.concat(F.lit("a"), F.col("id") % 200).alias("ar"))
    frames = [R.standardize_pairs(pairs.repartition(130), name=n) for n in ("one", "two")]
    merged = R.union_sources(frames).withColumn("id", F.col("source_rank").cast("long") * F.lit(1 << 40) + F.col("row_id"))
    assert merged.select("id").distinct().count() == merged.count() == 520
    again = R.standardize_pairs(pairs.repartition(7), name="one")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, frames[0].collect()), key=str)


def test_preview_takes_rows_of_every_split(spark):
    rows = spark.range(100).select(F.col("id").alias("row_id"), F.when(F.col("id") < 90, "train").otherwise("test").alias("split_name"))
    got = sorted((r.split_name, r.row_id) for r in R.preview_source(rows, 3).collect())
    assert got == [("test", 90), ("test", 91), ("test", 92), ("train", 0), ("train", 1), ("train", 2)]


def test_caps_follow_the_order_of_the_splits(spark):
    rows = spark.range(30).select(F.col("id").alias("row_id"), F.element_at(F.array(F.lit("b"), F.lit("a"), F.lit("train")), (F.col("id") % 3 + 1).cast("int")).alias("split_name"))
    got = {r.row_id for r in R.cap_rows(rows, 15, splits=("b", "train")).collect()}
    assert got == {i for i in range(30) if i % 3 == 0} | {2, 5, 8, 11, 14}
    with pytest.raises(ValueError):
        R.cap_rows(rows.limit(0), 5)


def test_split_sizes(spark):
    rows = spark.createDataFrame([("train",), ("val",), ("test",)], "split string")
    assert SP.check_split_sizes(rows).count() == 3
    with pytest.raises(ValueError, match="val"):
        SP.check_split_sizes(rows.where("split <> 'val'"))
    with pytest.raises(ValueError, match="none"):
        SP.check_split_sizes(rows.unionByName(spark.createDataFrame([("dev",)], "split string")))


def test_training_data_from_a_corpus_of_two_columns(spark, tmp_path):
    """The corpus as the reference writes it: en and ar alone."""
    pairs = spark.range(400).select(
        F.concat(F.lit("word "), F.col("id"), F.lit(" and more")).alias("en"), F.concat(F.lit("كلمة "), F.col("id")).alias("ar")
    )
    pairs.write.parquet(str(tmp_path / "corpus"))
    model = PL.prepare_training(spark, str(tmp_path / "corpus"), str(tmp_path / "out"), vocab_size=300)
    rows = spark.read.parquet(str(tmp_path / "out/bidirectional"))
    assert rows.count() == rows.select("row_id").distinct().count() == 800
    tokens = spark.read.parquet(str(tmp_path / "out/tokenized"))
    assert tokens.count() == 800 and len(model.tokens) == 300
