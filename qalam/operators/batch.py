"""Batching: exact global positions, consecutive fixed-size batches, batch-longest padding and
token volume per optimizer step.

Global positions never go through a single-partition window. The frame is range-partitioned
on the order key and sorted within partitions; each row gets its in-partition index; the
per-partition row counts (one row per partition -- a bound fixed by the partition count, not
by the data) are turned into prefix offsets and broadcast back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LABEL_PAD = -100


#: Rows of a table of starts that every task may be given.
FEW_STARTS = 100_000


def global_index(df: DataFrame, order_cols: list[str | Column], num_partitions: int | None = None, pos_col: str = "_pos") -> DataFrame:
    """Add the 0-based position of each row in ``order_cols`` order (ties must not exist).

    The range-partitioned, sorted frame is checkpointed to the session's shared checkpoint
    folder, so the ids are computed once and survive executor loss.
    """
    return _indexed(df, order_cols, num_partitions, pos_col).drop("_pid")


def _indexed(df: DataFrame, order_cols: list[str | Column], num_partitions: int | None = None, pos_col: str = "_pos") -> DataFrame:
    """:func:`global_index`, and the range partition ``_pid`` of each row."""
    from qalam.session import checkpoint_dir

    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranged = (
        df.repartitionByRange(n, *cols)
        .sortWithinPartitions(*cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_base"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_base", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (
        ranged.join(F.broadcast(offsets), "_pid")
        .withColumn(pos_col, (F.col("_off") + F.col("_mid") - F.col("_base")).cast("long"))
        .drop("_mid", "_base", "_off")
    )


def assign_batches(
    df: DataFrame,
    batch_size: int,
    order_cols: list[str | Column],
    batch_col: str = "batch_id",
    group_cols: list[str] | None = None,
) -> DataFrame:
    """Consecutive batches of ``batch_size`` rows in ``order_cols`` order; the last may be short;
    ``ceil(n / batch_size)`` batches. Adds ``batch_id`` and ``pos`` (global position).

    With ``group_cols`` (e.g. ``split``) batches never cross groups: positions are counted from each
    group's first row (one global ordering by group then order key). The starts are one row per group
    and range partition. Every task gets them if they are few; else they are joined by group and range
    partition, so that a large group is dealt over as many tasks as it has partitions.
    """
    groups = list(group_cols or [])
    idx = _indexed(df, [*groups, *order_cols])
    if groups:
        starts = idx.groupBy("_pid", *groups).agg(F.min("_pos").alias("_first"))
        starts = starts.select("_pid", *groups, F.min("_first").over(Window.partitionBy(*groups)).alias("_start"))
        if starts.limit(FEW_STARTS + 1).count() <= FEW_STARTS:
            starts = F.broadcast(starts)
        idx = idx.join(starts, ["_pid", *groups]).withColumn("_pos", F.col("_pos") - F.col("_start")).drop("_start")
    return idx.drop("_pid").withColumn(batch_col, F.floor(F.col("_pos") / batch_size).cast("long")).withColumnRenamed("_pos", "pos")


def pad_batches(df: DataFrame, pad_id: int = 0, batch_col: str | list[str] = "batch_id") -> DataFrame:
    """Pad ``input_ids``/``attention_mask`` to the batch's longest input (pad id / 0) and
    ``labels`` to the batch's longest label (-100). Adds ``input_len``/``label_len``.

    ``batch_col`` may be a list (e.g. ``["split", "batch_id"]``); a batch holds ``batch_size``
    rows, so the window groups are bounded."""
    w = Window.partitionBy(*([batch_col] if isinstance(batch_col, str) else batch_col))
    in_max = F.max(F.size("input_ids")).over(w)
    lab_max = F.max(F.size("labels")).over(w)
    staged = df.withColumns({"_in_max": in_max, "_lab_max": lab_max})
    n_in = F.col("_in_max") - F.size("input_ids")
    n_lab = F.col("_lab_max") - F.size("labels")
    return staged.withColumns(
        {
            "input_ids": F.concat("input_ids", F.array_repeat(F.lit(pad_id), n_in)),
            "attention_mask": F.concat("attention_mask", F.array_repeat(F.lit(0), n_in)),
            "labels": F.concat("labels", F.array_repeat(F.lit(LABEL_PAD), n_lab)),
            "input_len": F.col("_in_max").cast("long"),
            "label_len": F.col("_lab_max").cast("long"),
        }
    ).drop("_in_max", "_lab_max")


def tokens_per_step(
    per_batch: DataFrame,
    grad_accum: int,
    max_steps: int = 200,
    batch_col: str = "batch_id",
) -> DataFrame:
    """Source and target tokens summed per accumulation window of ``grad_accum`` batches.

    Input ``(batch_id, src_tokens, tgt_tokens)`` per row or per batch. Only complete windows,
    the first ``max_steps`` of them. Output ``optimizer_step`` is 1-based.
    """
    step = (F.floor(F.col(batch_col) / grad_accum) + 1).cast("long")
    per = per_batch.groupBy(step.alias("optimizer_step")).agg(
        F.sum("src_tokens").cast("long").alias("src_tokens"),
        F.sum("tgt_tokens").cast("long").alias("tgt_tokens"),
        F.count_distinct(batch_col).alias("_nb"),
    )
    full = per.where((F.col("_nb") == grad_accum) & (F.col("optimizer_step") <= max_steps))
    return full.select("optimizer_step", "src_tokens", "tgt_tokens", (F.col("src_tokens") + F.col("tgt_tokens")).alias("total_tokens"))


def tokens_per_step_summary(steps: DataFrame) -> DataFrame:
    return steps.agg(
        F.count(F.lit(1)).cast("long").alias("steps"),
        F.avg("total_tokens").alias("mean"),
        F.percentile("total_tokens", 0.5).alias("p50"),
        F.percentile("total_tokens", 0.9).alias("p90"),
        F.min("total_tokens").alias("min"),
        F.max("total_tokens").alias("max"),
    )


def token_counts(input_ids: str = "attention_mask", labels: str = "labels") -> dict[str, Column]:
    """Non-pad source tokens (sum of the mask) and non -100 label tokens of a padded row."""
    return {
        "src_tokens": F.aggregate(input_ids, F.lit(0).cast("long"), lambda acc, x: acc + x),
        "tgt_tokens": F.size(F.filter(labels, lambda x: x != LABEL_PAD)).cast("long"),
    }
