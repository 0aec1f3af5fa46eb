"""End-to-end jobs a user runs: corpus build (stage 1), training-data preparation (stage 2)
and evaluation of predictions. Each writes its outputs to the given folder; every step is the
operator of the same name, so the plan stays one lazy DataFrame per output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalam.operators import batch as B
from qalam.operators import bpe as BPE
from qalam.operators import clean as C
from qalam.operators import encode as EN
from qalam.operators import predict as PR
from qalam.operators import profile as P
from qalam.operators import sample as S
from qalam.operators import score as SC
from qalam.operators import split as SP
from qalam.plans.summary import eda_summary
from qalam.sources import readers as R
from qalam.sources import sinks as K


def build_corpus(
    spark: SparkSession,
    frames: list[tuple[str, DataFrame]],
    out_dir: str,
    max_seq_len: int = 128,
    seed: int = 42,
    preferred: dict[str, tuple[str | None, str | None]] | None = None,
    max_rows: dict[str, int] | None = None,
) -> dict:
    """Standardise and merge sources (``preferred`` names the en/ar columns per source, else
    the candidate lists decide, ``max_rows`` caps sources by name), clean with one dedup exchange,
    write the corpus, its metadata, the profile tables and the summary. Returns the summary."""
    preferred, max_rows = preferred or {}, max_rows or {}
    std = [R.cap_rows(R.standardize_pairs(df, name, *preferred.get(name, (None, None))), max_rows.get(name)) for name, df in frames]
    merged = R.union_sources(std)
    # global merge order: source rank, then the source's own row order
    merged = merged.withColumn("row_id", F.col("source_rank").cast("long") * F.lit(1 << 40) + F.col("row_id"))
    raw = merged.select("row_id", "en", "ar")
    cleaned = C.clean_pairs(raw)
    parquet, csv = (f"{out_dir}/final_cleaned_combined_dataset.{kind}" for kind in ("parquet", "csv"))
    K.write_pairs(cleaned.select("en", "ar", "row_id"), parquet, csv)
    corpus = spark.read.parquet(parquet)
    tables = {
        "word_length_stats": P.word_length_stats(corpus),
        "char_length_stats": P.char_length_stats(corpus),
        "anomaly_summary": P.script_anomalies(corpus).select("metric", "count", P.format_ratio("ratio").alias("ratio")),
        "truncation_estimate": P.truncation_estimate(corpus, max_seq_len).select("metric", "count", P.format_ratio("ratio").alias("ratio")),
        "top_en": P.top_sentences(corpus).where("side = 'en'").select(F.col("text").alias("en"), "count"),
        "top_ar": P.top_sentences(corpus).where("side = 'ar'").select(F.col("text").alias("ar"), "count"),
        "sample_preview": S.sample_exact(corpus, 10, seed).select("en", "ar"),
    }
    K.write_profile_tables(tables, out_dir)
    summary = eda_summary(raw, max_seq_len).first().asDict()
    K.write_json_metadata(spark, summary, f"{out_dir}/eda_summary.json")
    metadata = {key: summary[key] for key in ("rows", "columns")}
    metadata |= {"parquet_path": parquet, "csv_path": csv, "max_seq_len_reference": max_seq_len}
    K.write_json_metadata(spark, metadata, f"{out_dir}/final_cleaned_combined_dataset_metadata.json")
    return summary


def prepare_training(
    spark: SparkSession,
    cleaned_path: str,
    out_dir: str,
    vocab_size: int = 32_000,
    max_len: int = 128,
    ratios: tuple[float, float, float] = (0.90, 0.05, 0.05),
) -> BPE.BPEModel:
    """Blank filter -> hash split (+ leakage check) -> bidirectional rows -> BPE on train ->
    token ids, written partitioned by split. Returns the trained model."""
    pairs = R.read_pairs_parquet(spark, cleaned_path)
    if "row_id" not in pairs.columns:
        pairs = R.with_row_ids(pairs)
    split = SP.hash_split(C.drop_blank_pairs(pairs), *ratios)
    SP.assert_no_leakage(split)
    SP.check_split_sizes(split)
    bi = SP.bidirectional_expand(split)
    K.write_pairs(bi, f"{out_dir}/bidirectional", partition_by=["split"])
    bi = spark.read.parquet(f"{out_dir}/bidirectional")
    model = BPE.train_bpe(BPE.pretoken_counts(bi.where("split = 'train'"), ["source_text", "target_text"]), vocab_size=vocab_size)
    model.vocab_df(spark).write.mode("overwrite").parquet(f"{out_dir}/tokenizer/vocab")
    model.merges_df(spark).write.mode("overwrite").parquet(f"{out_dir}/tokenizer/merges")
    EN.encode_pairs(bi, model, max_len).write.mode("overwrite").partitionBy("split").parquet(f"{out_dir}/tokenized")
    return model


def evaluate(predictions: DataFrame, batch_size: int = 24) -> DataFrame:
    """One wide record of BLEU/chrF overall and per direction (the reference's eval row)."""
    return SC.eval_record(SC.scores_by_direction(predictions, batch_size))


def evaluate_predictor(
    rows: DataFrame, predictor, max_batches: int, batch_size: int = 24, seed: int = 42
) -> DataFrame:
    """Sample exactly ``max_batches * batch_size`` bidirectional rows (all, if there are fewer), predict
    them in batches, align predictions with references by key, and score: one record, with zero
    samples and NaN scores where there are no rows."""
    sample = S.sample_exact(rows.select("row_id", "direction", "source_text", "target_text"), max_batches * batch_size, seed)
    predicted = PR.batch_predict(sample, predictor, batch_size=batch_size).select("row_id", "prediction")
    return evaluate(SC.align_predictions(sample, predicted), batch_size)


def padded_batches(tokenized: DataFrame, batch_size: int, seed: int = 42) -> DataFrame:
    return B.pad_batches(B.assign_batches(tokenized, batch_size, [S.draw_key(seed), F.col("row_id")]))
