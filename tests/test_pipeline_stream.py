"""End-to-end corpus build and the streaming cleaning path."""

from pyspark.sql import functions as F

from qalam.operators import clean as C
from qalam.plans import pipeline as PL
from qalam.sources import fixtures as FX
from qalam.streaming import clean as ST

SF001 = "/root/testdata/sf0.001"


def test_build_corpus(spark, tmp_path):
    out = str(tmp_path / "eda")
    pref = dict(zip(FX.SOURCE_NAMES, FX.SOURCE_COLUMNS))
    summary = PL.build_corpus(spark, FX.source_frames(spark, SF001), out, preferred=pref)
    corpus = spark.read.parquet(f"{out}/final_cleaned_combined_dataset.parquet")
    assert summary["rows"] == corpus.count()
    assert summary["duplicate_pairs_before_dedup"] > 0
    top_en = spark.read.option("header", True).csv(f"{out}/top_en")
    assert top_en.count() == 10
    assert spark.read.option("header", True).csv(f"{out}/anomaly_summary").where(F.col("ratio").endswith("%")).count() == 2


def test_stream_matches_batch(spark, tmp_path):
    raw = FX.raw_pairs(spark, SF001)
    src = str(tmp_path / "in")
    raw.write.parquet(src)
    q = ST.write_clean_stream(ST.read_pair_stream(spark, src), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = C.clean_rows(raw)
    assert sorted(map(tuple, streamed.select("row_id", "en", "ar").collect())) == sorted(map(tuple, batch.select("row_id", "en", "ar").collect()))


def test_build_corpus_caps_and_metadata(spark, tmp_path):
    out = str(tmp_path / "eda")
    pref = dict(zip(FX.SOURCE_NAMES, FX.SOURCE_COLUMNS))
    frames = FX.source_frames(spark, SF001)[:2]
    summary = PL.build_corpus(spark, frames, out, preferred=pref, max_rows={frames[0][0]: 5, frames[1][0]: 7})
    meta = spark.read.json(f"{out}/final_cleaned_combined_dataset_metadata.json").first()
    assert summary["columns"] == meta["columns"] == ["en", "ar"]
    assert summary["rows"] == meta["rows"] <= 12
    assert spark.read.parquet(meta["parquet_path"]).count() == meta["rows"]


def test_evaluation_job(spark):
    from qalam.operators import predict as PR
    from qalam.operators import score as SC
    from qalam.operators import split as SP

    rows = SP.bidirectional_expand(SP.hash_split(C.drop_blank_pairs(C.clean_pairs(FX.raw_pairs(spark, SF001)))))
    record = PL.evaluate_predictor(rows, PR.CopySourcePredictor(), max_batches=3, batch_size=8).first()
    assert (record.num_samples, record.num_batches) == (24, 3)
    whole = PL.evaluate_predictor(rows, PR.CopySourcePredictor(), max_batches=10**6, batch_size=8).first()
    predicted = PR.batch_predict(rows.select("row_id", "direction", "source_text", "target_text"), PR.CopySourcePredictor(), batch_size=8)
    assert whole.num_samples == rows.count()
    assert abs(whole.chrf - SC.corpus_chrf(predicted).first().chrf) < 1e-9
    none = PL.evaluate_predictor(rows.limit(0), PR.CopySourcePredictor(), max_batches=3).first()
    assert none.num_samples == 0 and none.bleu != none.bleu
