"""Registered run-log and batching queries (metric logs derived from ``events``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from qalam.functions import text as T
from qalam.operators import batch as B
from qalam.operators import runlog as L
from qalam.operators import sample as S
from qalam.plans.corpus import SEED, bidir
from qalam.sources import fixtures as FX

# reference bidirectional train size, used for the epoch estimate of the interval log
REFERENCE_TRAIN_ROWS = 1_489_852


def log(spark, d):
    return L.upsert_metric_log(FX.metric_log(spark, d))


def q_coerce_numeric(spark, d):
    ev = FX.table(spark, d, "events")
    text_log = ev.select(
        (F.col("user_id") % 5).alias("run_id"),
        ((F.col("event_id") % 200) * 40).cast("string").alias("step"),
        F.col("event_id").alias("ingest_seq"),
        (F.col("value") / 50).cast("string").alias("val_loss"),
        (F.col("value") % 30).cast("string").alias("bleu"),
        "props",
    )
    return L.coerce_numeric(text_log, ["val_loss", "bleu", "props"])


def q_loss_to_ppl(spark, d):
    return log(spark, d).select("run_id", "step", "val_loss", F.round(L.loss_to_ppl("val_loss"), 6).alias("val_ppl"))


def q_upsert_metric_log(spark, d):
    return log(spark, d)


def q_sort_by_step(spark, d):
    return L.sort_by_step(log(spark, d)).select("run_id", "step", "val_loss")


def q_best_points(spark, d):
    return L.best_points(log(spark, d))


def q_rolling_mean(spark, d):
    return L.rolling_mean(log(spark, d), "val_loss", 5)


def q_running_best(spark, d):
    return L.running_best(log(spark, d), "val_loss")


def q_retain_last_n(spark, d):
    """Checkpoints exist at the save cadence; keep the newest 10 per run."""
    saved = log(spark, d).where(L.cadence_flags("step")["should_save"])
    return L.retain_last_n(saved, 10)


def q_cadence_flags(spark, d):
    return log(spark, d).select("run_id", "step", *[v.alias(k) for k, v in L.cadence_flags("step").items()])


def micro_steps(spark, d):
    ev = FX.table(spark, d, "events")
    return ev.select(F.lit(0).cast("long").alias("run_id"), F.col("event_id").alias("micro"), "ts", (F.col("value") / 50).alias("loss"))


def q_interval_metrics(spark, d):
    out = L.interval_metrics(micro_steps(spark, d), train_rows=REFERENCE_TRAIN_ROWS)
    return out.select(
        "run_id", "interval_end", F.round("avg_loss", 6).alias("avg_loss"), F.round("ppl", 6).alias("ppl"), "steps",
        F.round("seconds", 6).alias("seconds"), F.round("steps_per_sec", 6).alias("steps_per_sec"),
        F.round("sec_per_step", 6).alias("sec_per_step"), "examples_seen", F.round("approx_epochs", 6).alias("approx_epochs"),
    )


def q_validation_loss(spark, d):
    ev = FX.table(spark, d, "events")
    batches = ev.select(F.col("event_id").alias("batch_idx"), (F.col("value") / 50).alias("loss"))
    out = L.validation_loss(batches, 300)
    return out.select(F.round("val_loss", 6).alias("val_loss"), F.round("val_ppl", 6).alias("val_ppl"))


def q_training_volume(spark, d):
    return L.training_volume(bidir(spark, d).where(F.col("split") == "train"))


def _batched(rows):
    """Consecutive batches of 24 within each split, in the seeded draw order."""
    return B.assign_batches(rows, 24, [S.draw_key(SEED), F.col("row_id")], group_cols=["split"])


def q_assign_batches(spark, d):
    return _batched(bidir(spark, d).select("row_id", "split")).select("row_id", "split", "batch_id")


def q_tokens_per_step(spark, d):
    """Tokens are counted before rows are ordered, so that two numbers move instead of two texts."""
    counted = bidir(spark, d).select(
        "row_id", "split", T.word_count("source_text").alias("src_tokens"), T.word_count("target_text").alias("tgt_tokens")
    )
    b = _batched(counted).where(F.col("split") == "train").select("batch_id", "src_tokens", "tgt_tokens")
    return B.tokens_per_step(b, grad_accum=L.GRAD_ACCUM, max_steps=200)


def q_tokens_per_step_summary(spark, d):
    s = B.tokens_per_step_summary(q_tokens_per_step(spark, d))
    return s.select("steps", F.round("mean", 6).alias("mean"), F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"), "min", "max")


QUERIES = {
    "coerce_numeric": q_coerce_numeric,
    "loss_to_ppl": q_loss_to_ppl,
    "upsert_metric_log": q_upsert_metric_log,
    "sort_by_step": q_sort_by_step,
    "best_points": q_best_points,
    "rolling_mean": q_rolling_mean,
    "running_best": q_running_best,
    "retain_last_n": q_retain_last_n,
    "cadence_flags": q_cadence_flags,
    "interval_metrics": q_interval_metrics,
    "validation_loss": q_validation_loss,
    "training_volume": q_training_volume,
    "assign_batches": q_assign_batches,
    "tokens_per_step": q_tokens_per_step,
    "tokens_per_step_summary": q_tokens_per_step_summary,
}
