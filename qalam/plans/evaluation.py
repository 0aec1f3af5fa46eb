"""Registered evaluation queries: predictions -> alignment -> BLEU/chrF overall and per direction."""

from __future__ import annotations

from pyspark.sql import functions as F

from qalam.operators import predict as PR
from qalam.operators import score as SC
from qalam.plans.corpus import bidir, cleaned
from qalam.sources import fixtures as FX

EVAL_BATCH = 24


def _r6(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def q_trim_predictions(spark, d):
    return SC.trim_predictions(FX.predictions(spark, d)).select("row_id", "prediction", "target_text")


def q_align_predictions(spark, d):
    p = FX.predictions(spark, d)
    refs = p.select("row_id", "direction", "source_text", "target_text")
    preds = p.select("row_id", "prediction")
    return SC.align_predictions(refs, preds)


def q_corpus_bleu(spark, d):
    return _r6(SC.corpus_bleu(FX.predictions(spark, d)), {"bleu"})


def q_corpus_chrf(spark, d):
    return _r6(SC.corpus_chrf(FX.predictions(spark, d)), {"chrf"})


def q_scores_by_direction(spark, d):
    return _r6(SC.scores_by_direction(FX.predictions(spark, d), EVAL_BATCH), {"bleu", "chrf"})


def q_eval_text_metrics(spark, d):
    rec = SC.eval_record(SC.scores_by_direction(FX.predictions(spark, d), EVAL_BATCH))
    return _r6(rec, {"bleu", "chrf", "bleu_en_to_ar", "bleu_ar_to_en", "chrf_en_to_ar", "chrf_ar_to_en"})


def q_batch_predict(spark, d):
    rows = bidir(spark, d).where(F.col("split") == "test").select("row_id", "direction", "source_text", "target_text")
    return PR.batch_predict(rows, PR.CopySourcePredictor(), batch_size=EVAL_BATCH)


def q_map_batches(spark, d):
    schema = "row_id long, en_chars long, ar_chars long"
    return PR.map_batches(cleaned(spark, d).select("row_id", "en", "ar"), PR.char_lengths, schema)


QUERIES = {
    "trim_predictions": q_trim_predictions,
    "align_predictions": q_align_predictions,
    "corpus_bleu": q_corpus_bleu,
    "corpus_chrf": q_corpus_chrf,
    "scores_by_direction": q_scores_by_direction,
    "eval_text_metrics": q_eval_text_metrics,
    "batch_predict": q_batch_predict,
    "map_batches": q_map_batches,
}
