"""EDA summary: the reference's one-object corpus summary as a one-row DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalam.operators.clean import cleaning_funnel


def eda_summary(raw_pairs: DataFrame, max_seq_len: int = 128) -> DataFrame:
    f = cleaning_funnel(raw_pairs)
    dup = F.col("merged") - F.col("after_dedup")
    return f.select(
        F.col("final").alias("rows"),
        F.array(F.lit("en"), F.lit("ar")).alias("columns"),
        F.lit(max_seq_len).cast("long").alias("max_seq_len_reference"),
        dup.alias("duplicate_pairs_before_dedup"),
        F.when(F.col("merged") > 0, dup / F.col("merged")).otherwise(F.lit(0.0)).alias("duplicate_ratio_before_dedup"),
        F.col("swapped").alias("swap_count"),
        F.col("removed_after_swap").alias("rededup_removed_after_swap"),
        F.col("diacritic_chars").alias("diacritics_removed_chars"),
    )
