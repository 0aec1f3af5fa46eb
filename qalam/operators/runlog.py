"""Run-metric logs: coercion, keep-last upsert, best points, smoothing, running best, retention,
cadence flags, interval aggregation, validation loss and training-volume arithmetic.

Logs are keyed by ``(run_id, step)``. No window is ever partitioned by ``run_id`` alone: one run
may hold a large share of all rows. Order-dependent operators take each row's global position
in ``(run_id, step)`` order from a range-partitioned index (``batch.global_index``) and window
only inside ``(run_id, bucket)`` groups of at most ``bucket_rows`` positions; what crosses a
bucket edge travels as a one-row-per-bucket carry or as a few halo rows. Keep-last and
arg-min/arg-max use ``max_by``/``min_by`` aggregates, which combine map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
#   metrics and their optimisation direction for the best-point summary
BEST_POINT_METRICS = [
    ("val_loss", "min"),
    ("val_ppl", "min"),
    ("bleu", "max"),
    ("chrf", "max"),
    ("comet", "max"),
    ("bleu_en_to_ar", "max"),
    ("bleu_ar_to_en", "max"),
    ("chrf_en_to_ar", "max"),
    ("chrf_ar_to_en", "max"),
]
#   loss is clipped at 20 before exponentiation
PPL_LOSS_CAP = 20.0
#   training cadence defaults
LOG_EVERY, EVAL_EVERY, SAVE_EVERY, MAX_STEPS = 40, 400, 500, 32_000
BATCH_SIZE, GRAD_ACCUM = 24, 32
# ---------------------------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c: Column | str) -> Column:
    x = _c(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def run_id_of(ts: Column | str) -> Column:
    """A run's id: its start as ``yyyyMMdd_HHmmss`` in the session's time zone."""
    return F.date_format(_c(ts), "yyyyMMdd_HHmmss")


def iso_text(ts: Column | str) -> Column:
    """A timestamp as ISO 8601 text, with microseconds where there are some."""
    whole = F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(_c(ts), "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def loss_to_ppl(c: Column | str) -> Column:
    """exp(min(loss, 20)); null, NaN and +-inf give NaN."""
    x = _c(c).cast("double")
    return F.when(is_finite(x), F.exp(F.least(x, F.lit(PPL_LOSS_CAP)))).otherwise(F.lit(float("nan")))


def coerce_numeric(df: DataFrame, cols: list[str], step_col: str = "step") -> DataFrame:
    """Unparseable text -> null (``try_cast``; plain ``cast`` throws under ANSI mode)."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.expr(f"try_cast(`{c}` AS DOUBLE)"))
    if step_col in df.columns:
        out = out.withColumn(step_col, F.expr(f"try_cast(try_cast(`{step_col}` AS DOUBLE) AS BIGINT)"))
    return out


def sort_by_step(df: DataFrame, run_col: str = "run_id", step_col: str = "step") -> DataFrame:
    return df.orderBy(run_col, step_col)


def upsert_metric_log(
    df: DataFrame, keys: tuple[str, ...] = ("run_id", "step"), seq_col: str = "ingest_seq"
) -> DataFrame:
    """Append semantics of a rewritten log: one row per key, the last ingested wins. ``seq_col`` numbers
    the ingests, so it does not repeat within a key. One ``max_by`` per column, whose buffers are plain
    numbers, makes this a hash aggregate."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*[F.max_by(c, seq_col).alias(c) for c in others])


def best_points(
    df: DataFrame,
    metrics: list[tuple[str, str]] | None = None,
    run_col: str = "run_id",
    step_col: str = "step",
) -> DataFrame:
    """Per run and metric: the step and value of the best finite value; ties -> earliest step.

    Absent columns and all-null metrics produce no row.
    """
    metrics = [(m, mode) for m, mode in (metrics or BEST_POINT_METRICS) if m in df.columns]
    if not metrics:
        raise ValueError("no metric columns present")
    long = df.select(
        F.col(run_col).alias("run_id"),
        F.col(step_col).cast("long").alias("step"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("metric"),
                        F.col(m).cast("double").alias("value"),
                        F.lit(mode == "min").alias("is_min"),
                    )
                    for m, mode in metrics
                ]
            )
        ).alias("m"),
    ).select("run_id", "step", "m.*")
    long = long.where(is_finite("value"))
    score = F.when(F.col("is_min"), F.col("value")).otherwise(-F.col("value"))
    # one hash aggregate over numbers: the first step of every score, then the best of these
    first = long.groupBy("run_id", "metric", score.alias("score")).agg(F.min("step").alias("step"), F.min("value").alias("value"))
    return first.groupBy("run_id", "metric").agg(F.min_by("step", "score").alias("step"), F.min_by("value", "score").alias("value"))


BUCKET_ROWS = 1 << 20


def _positions(df: DataFrame, value_col: str, run_col: str, step_col: str) -> DataFrame:
    """``(run_id, step, value, _pos)`` with ``_pos`` the global 0-based rank in (run, step) order."""
    from qalam.operators.batch import global_index

    base = df.select(
        F.col(run_col).alias("run_id"), F.col(step_col).alias("step"), F.col(value_col).cast("double").alias("value")
    )
    return global_index(base, ["run_id", "step"])


def _finite_value() -> Column:
    return F.when(is_finite("value"), F.col("value"))


def rolling_mean(
    df: DataFrame,
    value_col: str,
    n: int = 5,
    run_col: str = "run_id",
    step_col: str = "step",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Trailing mean over the last ``n`` log points (min_periods=1, NaN/null skipped).

    The window runs per ``(run_id, bucket)``; the last ``n - 1`` rows of each bucket are copied
    into the next bucket as halo rows, so rows at a bucket start still see their predecessors.
    """
    if n < 1 or bucket_rows < n:
        raise ValueError("need 1 <= n <= bucket_rows")
    idx = _positions(df, value_col, run_col, step_col)
    bucket = F.floor(F.col("_pos") / bucket_rows)
    own = idx.withColumns({"_b": bucket, "_halo": F.lit(False)})
    halo = idx.where(F.col("_pos") % bucket_rows >= bucket_rows - (n - 1)).withColumns({"_b": bucket + 1, "_halo": F.lit(True)})
    w = Window.partitionBy("run_id", "_b").orderBy("_pos").rowsBetween(-(n - 1), 0)
    out = own.unionByName(halo).select("run_id", "step", "value", "_halo", F.avg(_finite_value()).over(w).alias("smooth"))
    return out.where(~F.col("_halo")).drop("_halo")


def running_best(
    df: DataFrame,
    value_col: str,
    seed: float | None = None,
    run_col: str = "run_id",
    step_col: str = "step",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """A row is a new best if finite and strictly below every earlier finite value of its run
    (and below ``seed``, the best value restored from a checkpoint on resume).

    Prefix minimum in two levels: inside a ``(run_id, bucket)`` window, and a carry -- the
    minimum of all earlier buckets of the run -- from the one-row-per-bucket minima.
    """
    idx = _positions(df, value_col, run_col, step_col).withColumn("_b", F.floor(F.col("_pos") / bucket_rows))
    v = _finite_value()
    mins = idx.groupBy("run_id", "_b").agg(F.min(v).alias("_bm"))
    carry = mins.select(
        "run_id",
        "_b",
        F.min("_bm").over(Window.partitionBy("run_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"),
    )
    inside = F.min(v).over(Window.partitionBy("run_id", "_b").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1))
    # null runs are a run of their own
    carry = carry.select(F.col("run_id").alias("_run"), F.col("_b").alias("_cb"), "_carry")
    same = F.col("run_id").eqNullSafe(F.col("_run")) & (F.col("_b") == F.col("_cb"))
    staged = idx.join(carry, same).select("run_id", "step", "value", F.least("_carry", inside).alias("_before"))
    before = F.col("_before")
    bound = F.least(before, F.lit(seed).cast("double")) if seed is not None else before
    is_best = v.isNotNull() & (bound.isNull() | (v < bound))
    return staged.select(
        "run_id",
        "step",
        "value",
        F.coalesce(is_best, F.lit(False)).alias("is_best"),
        F.least(bound, v).alias("best_so_far"),
    )


def retain_last_n(df: DataFrame, n: int | None, run_col: str = "run_id", step_col: str = "step") -> DataFrame:
    """Flag the newest ``n`` saved items per run (null n keeps all). Deletes nothing.

    A row is kept when fewer than ``n`` rows of its run come after it: the run's last global
    position (a map-side-combined max per run) minus the row's position."""
    if n is None or n <= 0:
        return df.select(F.col(run_col).alias("run_id"), F.col(step_col).alias("step"), F.lit(True).alias("keep"))
    from qalam.operators.batch import global_index

    idx = global_index(df.select(F.col(run_col).alias("run_id"), F.col(step_col).alias("step")), ["run_id", "step"])
    ends = idx.groupBy(F.col("run_id").alias("_run")).agg(F.max("_pos").alias("_end"))
    return idx.join(ends, F.col("run_id").eqNullSafe(F.col("_run"))).select("run_id", "step", ((F.col("_end") - F.col("_pos")) < n).alias("keep"))


def cadence_flags(
    step: Column | str = "step",
    log_every: int = LOG_EVERY,
    eval_every: int = EVAL_EVERY,
    save_every: int = SAVE_EVERY,
    max_steps: int = MAX_STEPS,
) -> dict[str, Column]:
    s = _c(step)
    return {
        "should_log": (s % log_every == 0) | (s == 1),
        "should_eval": (s % eval_every == 0) | (s == max_steps),
        "should_save": (s % save_every == 0) | (s == max_steps),
    }


def interval_metrics(
    micro: DataFrame,
    grad_accum: int = GRAD_ACCUM,
    batch_size: int = BATCH_SIZE,
    log_every: int = LOG_EVERY,
    train_rows: int | None = None,
    run_col: str = "run_id",
) -> DataFrame:
    """Aggregate micro-step losses into the reference's logging intervals.

    Input: ``(run_id, micro, ts, loss)`` with 0-based consecutive ``micro``. Optimizer step
    ``s = micro // grad_accum + 1`` completes with its last micro-step; a row is logged at
    ``s == 1`` and every ``s % log_every == 0`` and covers the micro-steps since the previous
    log. Only intervals whose closing step was completed are reported. ``seconds`` runs from the
    previous log, the first micro-step for the first one, to this log. Arithmetic on the step id,
    one hash aggregate and a join of each interval to the one before: no ordering window.
    """
    s = F.floor(F.col("micro") / grad_accum).cast("long") + 1
    end = F.when(s == 1, F.lit(1).cast("long")).otherwise((F.ceil(s / log_every) * log_every).cast("long"))
    prev_end = F.when(F.col("interval_end") == 1, F.lit(0).cast("long")).when(
        F.col("interval_end") == log_every, F.lit(1).cast("long")
    ).otherwise(F.col("interval_end") - log_every)
    tagged = micro.select(F.col(run_col).alias("run_id"), "micro", "ts", F.col("loss").cast("double").alias("loss"), end.alias("interval_end"))
    done_micro = micro.groupBy(F.col(run_col).alias("run_id")).agg(F.max("micro").alias("_last_micro"))
    agg = tagged.groupBy("run_id", "interval_end").agg(
        F.avg("loss").alias("avg_loss"),
        F.count(F.lit(1)).alias("micro_steps"),
        F.min("ts").alias("_first"),
        F.max("ts").alias("_last"),
    )
    before = agg.select(F.col("run_id").alias("_run"), F.col("interval_end").alias("_end"), F.col("_last").alias("_logged"))
    previous = F.col("run_id").eqNullSafe(F.col("_run")) & (prev_end == F.col("_end"))
    agg = agg.join(before, previous, "left").withColumn(
        "seconds", F.expr("timestampdiff(MICROSECOND, coalesce(_logged, _first), _last)") / 1e6
    )
    done_micro = done_micro.withColumnRenamed("run_id", "_done_run")
    # the closing micro-step of interval e is e*grad_accum - 1 (0-based)
    complete = agg.join(done_micro, F.col("run_id").eqNullSafe(F.col("_done_run"))).where(F.col("interval_end") * grad_accum - 1 <= F.col("_last_micro"))
    steps = (F.col("interval_end") - prev_end).cast("long")
    sps = F.when(F.col("seconds") > 0, steps / F.col("seconds")).otherwise(F.lit(0.0))
    examples = (F.col("interval_end") * (batch_size * grad_accum)).cast("long")
    epochs = examples / F.lit(train_rows) if train_rows else F.lit(float("nan"))
    return complete.select(
        "run_id",
        "interval_end",
        "avg_loss",
        loss_to_ppl("avg_loss").alias("ppl"),
        steps.alias("steps"),
        "seconds",
        sps.alias("steps_per_sec"),
        F.when(sps > 0, 1.0 / sps).otherwise(F.lit(float("inf"))).alias("sec_per_step"),
        examples.alias("examples_seen"),
        epochs.alias("approx_epochs"),
    )


def validation_loss(batches: DataFrame, max_batches: int | None = 300, idx_col: str = "batch_idx", loss_col: str = "loss") -> DataFrame:
    """Unweighted mean of per-batch losses over the first ``max_batches``; none -> NaN."""
    b = batches if max_batches is None else batches.where(F.col(idx_col) < max_batches)
    agg = b.agg(F.avg(F.col(loss_col).cast("double")).alias("m"))
    v = F.coalesce(F.col("m"), F.lit(float("nan")))
    return agg.select(v.alias("val_loss"), loss_to_ppl(v).alias("val_ppl"))


def training_volume(train: DataFrame, batch_size: int = BATCH_SIZE, grad_accum: int = GRAD_ACCUM, max_steps: int = MAX_STEPS) -> DataFrame:
    """Examples per micro-batch/step/total and epochs over the train split (metric, value)."""
    per_step = batch_size * grad_accum
    total = max_steps * per_step
    n = train.agg(F.count(F.lit(1)).alias("n"))
    epochs = F.when(F.col("n") > 0, F.lit(total) / F.col("n")).otherwise(F.lit(0.0))
    return n.select(
        F.expr(
            "stack(8, 'examples_per_micro_batch', {b}D, 'gradient_accumulation_steps', {g}D, "
            "'examples_per_optimizer_step', {p}D, 'max_steps', {m}D, 'examples_seen_total', {t}D, "
            "'train_examples', CAST(n AS DOUBLE), 'approx_epochs_over_train_split', CAST(0 AS DOUBLE), "
            "'coverage_percent_of_train_split %', CAST(0 AS DOUBLE)) AS (metric, value)".format(
                b=batch_size, g=grad_accum, p=per_step, m=max_steps, t=total
            )
        ),
        epochs.alias("_e"),
    ).select(
        "metric",
        F.when(F.col("metric") == "approx_epochs_over_train_split", F.bround("_e", 4))
        .when(F.col("metric") == "coverage_percent_of_train_split %", F.bround(F.col("_e") * 100, 2))
        .otherwise(F.col("value"))
        .alias("value"),
    )
