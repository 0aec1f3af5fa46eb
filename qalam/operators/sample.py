"""Exact, seeded, deterministic sampling and first-n views.

``df.sample(fraction)`` is Bernoulli and returns an approximate count; the reference takes exactly
``min(n, rows)`` rows. Here a row's draw key is ``md5(seed|row_id)`` and the sample is the ``n``
smallest keys. A histogram of the keys' first digits (at most 65,536 rows, combined map-side) tells
in which bin the n-th key lies; only that bin, a 65,536th of the rows, is ordered to find the key. The
sample is a filter by it. The same plan serves every ``n``; no task gathers the sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qalam.functions import text as T
from qalam.session import checkpoint_dir


def draw_key(seed: int, order_col: str = "row_id") -> Column:
    return F.md5(F.concat(F.lit(str(int(seed))), F.lit("|"), F.col(order_col).cast("string")))


#: Leading hex digits of a draw key that number its histogram bin.
BIN_DIGITS = 4


def sample_exact(df: DataFrame, n: int, seed: int = 42, order_col: str = "row_id") -> DataFrame:
    """Exactly min(n, rows) rows, without replacement, reproducible for a seed.

    The rows' ids are checkpointed once; the histogram and the n-th key are taken from them, and ``df``
    itself is read once more, by a filter."""
    n = int(n)
    if n <= 0:
        return df.limit(0)
    checkpoint_dir(df.sparkSession)
    ids = df.select(F.col(order_col).alias("id"), draw_key(seed, order_col).alias("key")).checkpoint(eager=True)
    bin_ = F.substring("key", 1, BIN_DIGITS)
    bins = ids.groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    upto = bins.select("bin", "n", F.sum("n").over(Window.orderBy("bin")).alias("upto"))
    edge = upto.where(F.col("upto") >= n).orderBy("bin").first()
    if edge is None:
        return df
    inside = ids.where(bin_ == edge.bin).orderBy("key", "id").limit(n - (edge.upto - edge.n))
    last = inside.agg(F.max(F.struct("key", "id")).alias("last")).first()["last"]
    key, kind = draw_key(seed, order_col), df.schema[order_col].dataType
    return df.where((key < last["key"]) | ((key == last["key"]) & (F.col(order_col) <= F.lit(last["id"]).cast(kind))))


def shuffle_take(df: DataFrame, k: int, seed: int = 42, order_col: str = "row_id") -> DataFrame:
    """Seeded shuffle then take ``k`` (sanity batches): same draw as :func:`sample_exact`."""
    return sample_exact(df, k, seed, order_col)


def head_rows(df: DataFrame, n: int, order_col: str = "row_id") -> DataFrame:
    """First ``n`` rows in row order."""
    return df.orderBy(order_col).limit(int(n))


def preview_pairs(df: DataFrame, n: int, mode: str = "both", seed: int = 42, order_col: str = "row_id") -> DataFrame:
    """Sample ``n`` rows and return ``(row_id, direction, source_text, reference_text)``.

    Rows that are already bidirectional pass through; base (en, ar) pairs expand to both
    directions (``mode='both'``) or to one direction chosen by the parity of a seeded hash.
    """
    cols = set(df.columns)
    picked = sample_exact(df, n, seed, order_col)
    if {"source_text", "target_text", "direction"} <= cols:
        return picked.select(
            F.col(order_col).cast("long").alias("row_id"),
            "direction",
            "source_text",
            F.col("target_text").alias("reference_text"),
        )
    if {"en", "ar"} <= cols:
        rid = F.col(order_col).cast("long")
        en, ar = F.col("en").cast("string"), F.col("ar").cast("string")
        fwd = F.struct(
            (rid * 2).alias("row_id"),
            F.lit(T.EN_TO_AR).alias("direction"),
            F.concat(F.lit(T.TAG_TO_AR), en).alias("source_text"),
            ar.alias("reference_text"),
        )
        bwd = F.struct(
            (rid * 2 + 1).alias("row_id"),
            F.lit(T.AR_TO_EN).alias("direction"),
            F.concat(F.lit(T.TAG_TO_EN), ar).alias("source_text"),
            en.alias("reference_text"),
        )
        if mode == "both":
            return picked.select(F.explode(F.array(fwd, bwd)).alias("r")).select("r.*")
        parity = F.substring(F.md5(F.concat(F.lit(f"{int(seed)}|dir|"), rid.cast("string"))), 32, 1)
        forward = parity.isin("0", "2", "4", "6", "8", "a", "c", "e")
        return picked.select(F.when(forward, fwd).otherwise(bwd).alias("r")).select("r.*")
    raise ValueError("a preview needs bidirectional rows (source_text, target_text, direction) or pairs (en, ar)")
