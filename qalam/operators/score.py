"""Translation scoring: corpus BLEU and chrF, overall and per direction.

Plan: one Arrow-batched function computes per-row n-gram statistics (no n-gram shuffle), a
single aggregate sums them under grouping sets ((), (direction)) -- partial sums combine
map-side, so the exchange carries one row per group per map task -- and the closed forms are
evaluated as Spark expressions on the summed statistics.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from qalam.functions import text as T
from qalam.functions.ngram import CHRF_BETA, CHRF_ORDER, STAT_FIELDS, stats_struct

STATS_SCHEMA = Ty.StructType([Ty.StructField(f, Ty.LongType()) for f in STAT_FIELDS])


def _stats_udf():
    @F.arrow_udf(STATS_SCHEMA)
    def ngram_stats(hyp: pa.Array, ref: pa.Array) -> pa.Array:
        return stats_struct(hyp, ref)

    return ngram_stats


def trim_predictions(df: DataFrame, pred_col: str = "prediction", ref_col: str = "target_text") -> DataFrame:
    """Strip predictions and references (Python ``str.strip``) before scoring."""
    return df.withColumns({pred_col: T.strip_text(T.fill_text(pred_col)), ref_col: T.strip_text(T.fill_text(ref_col))})


def with_stats(df: DataFrame, pred_col: str = "prediction", ref_col: str = "target_text") -> DataFrame:
    from qalam.session import ship_package

    ship_package(df.sparkSession)
    return df.withColumn("_st", _stats_udf()(F.col(pred_col), F.col(ref_col)))


def bleu_from_sums() -> Column:
    """sacreBLEU closed form over summed statistics (exp smoothing, max order 4)."""
    hyp, ref = F.col("hyp_len"), F.col("ref_len")
    bp = F.when(hyp < ref, F.when(hyp > 0, F.exp(1 - ref / hyp)).otherwise(F.lit(0.0))).otherwise(F.lit(1.0))
    logs = []
    zeros = F.lit(0)
    for n in range(1, 5):
        m, t = F.col(f"m{n}"), F.col(f"t{n}")
        zeros = zeros + F.when(m == 0, 1).otherwise(0)
        p = F.when(m > 0, F.lit(100.0) * m / t).otherwise(F.lit(100.0) / (F.pow(F.lit(2.0), zeros) * t))
        logs.append(F.log(p))
    any_total_zero = F.lit(False)
    for n in range(1, 5):
        any_total_zero = any_total_zero | (F.col(f"t{n}") == 0)
    all_zero = (F.col("m1") == 0) & (F.col("m2") == 0) & (F.col("m3") == 0) & (F.col("m4") == 0)
    score = bp * F.exp((logs[0] + logs[1] + logs[2] + logs[3]) / 4)
    return F.when(all_zero | any_total_zero, F.lit(0.0)).otherwise(score)


def chrf_from_sums(beta: int = CHRF_BETA) -> Column:
    """chrF closed form: precision/recall averaged over orders with both totals positive."""
    factor = float(beta * beta)
    eff = F.lit(0)
    prec = F.lit(0.0)
    rec = F.lit(0.0)
    for n in range(1, CHRF_ORDER + 1):
        h, r, m = F.col(f"ch{n}"), F.col(f"cr{n}"), F.col(f"cm{n}")
        ok = (h > 0) & (r > 0)
        eff = eff + F.when(ok, 1).otherwise(0)
        prec = prec + F.when(ok, m / h).otherwise(F.lit(0.0))
        rec = rec + F.when(ok, m / r).otherwise(F.lit(0.0))
    p = F.when(eff > 0, prec / eff).otherwise(F.lit(0.0))
    r_ = F.when(eff > 0, rec / eff).otherwise(F.lit(0.0))
    return F.when(p + r_ > 0, F.lit(100.0) * (1 + factor) * p * r_ / (factor * p + r_)).otherwise(F.lit(0.0))


def _sums():
    return [F.sum(f"_st.{f}").alias(f) for f in STAT_FIELDS]


def scores_by_direction(
    df: DataFrame,
    batch_size: int = 24,
    pred_col: str = "prediction",
    ref_col: str = "target_text",
    dir_col: str = "direction",
) -> DataFrame:
    """BLEU and chrF for all rows (``direction`` null) and per direction."""
    st = with_stats(trim_predictions(df, pred_col, ref_col), pred_col, ref_col)
    g = st.rollup(dir_col).agg(F.count(F.lit(1)).cast("long").alias("num_samples"), *_sums())
    return g.select(
        F.col(dir_col).alias("direction"),
        "num_samples",
        F.ceil(F.col("num_samples") / batch_size).cast("long").alias("num_batches"),
        bleu_from_sums().alias("bleu"),
        chrf_from_sums().alias("chrf"),
    )


def corpus_bleu(df: DataFrame, pred_col: str = "prediction", ref_col: str = "target_text") -> DataFrame:
    st = with_stats(trim_predictions(df, pred_col, ref_col), pred_col, ref_col)
    return st.agg(*_sums()).select(bleu_from_sums().alias("bleu"))


def corpus_chrf(df: DataFrame, pred_col: str = "prediction", ref_col: str = "target_text") -> DataFrame:
    st = with_stats(trim_predictions(df, pred_col, ref_col), pred_col, ref_col)
    return st.agg(*_sums()).select(chrf_from_sums().alias("chrf"))


def eval_record(scores: DataFrame) -> DataFrame:
    """One wide row named like the reference's text-metric record; empty input -> zeros/NaN."""
    nan = F.lit(float("nan"))
    g = scores.agg(
        F.max(F.when(F.col("direction").isNull(), F.col("num_samples"))).alias("num_samples"),
        F.max(F.when(F.col("direction").isNull(), F.col("num_batches"))).alias("num_batches"),
        F.max(F.when(F.col("direction").isNull(), F.col("bleu"))).alias("bleu"),
        F.max(F.when(F.col("direction").isNull(), F.col("chrf"))).alias("chrf"),
        F.max(F.when(F.col("direction") == T.EN_TO_AR, F.col("bleu"))).alias("bleu_en_to_ar"),
        F.max(F.when(F.col("direction") == T.AR_TO_EN, F.col("bleu"))).alias("bleu_ar_to_en"),
        F.max(F.when(F.col("direction") == T.EN_TO_AR, F.col("chrf"))).alias("chrf_en_to_ar"),
        F.max(F.when(F.col("direction") == T.AR_TO_EN, F.col("chrf"))).alias("chrf_ar_to_en"),
    )
    return g.select(
        F.coalesce("num_samples", F.lit(0).cast("long")).alias("num_samples"),
        F.coalesce("num_batches", F.lit(0).cast("long")).alias("num_batches"),
        *[F.coalesce(c, nan).alias(c) for c in ("bleu", "chrf")],
        nan.alias("comet"),
        *[F.coalesce(c, nan).alias(c) for c in ("bleu_en_to_ar", "bleu_ar_to_en", "chrf_en_to_ar", "chrf_ar_to_en")],
    )


def align_predictions(refs: DataFrame, preds: DataFrame, key: str = "row_id") -> DataFrame:
    """References with the prediction of the same key (the reference aligns parallel lists by position).

    Raises unless every key is on both sides exactly once: a missing or repeated one would drop or
    multiply rows. The check is one aggregate over the keys."""
    sides = refs.select(F.col(key).alias("k"), F.lit(1).alias("r"), F.lit(0).alias("p")).unionByName(
        preds.select(F.col(key).alias("k"), F.lit(0).alias("r"), F.lit(1).alias("p"))
    )
    per_key = sides.groupBy("k").agg(F.sum("r").alias("r"), F.sum("p").alias("p"))
    bad = per_key.agg(
        F.count_if((F.col("r") > 1) | (F.col("p") > 1) | F.col("k").isNull()).alias("repeated"),
        F.count_if(F.col("p") == 0).alias("unanswered"),
        F.count_if(F.col("r") == 0).alias("unasked"),
    ).first()
    if any(bad):
        raise ValueError(
            f"{key}: {bad.repeated} repeated or null, {bad.unanswered} without a prediction, {bad.unasked} without a reference"
        )
    return refs.join(preds, key, "inner")
