"""Deterministic leakage-free split, split/direction counts and bidirectional expansion.

The split is a pure function of the pair text, so it needs no shuffle, is stable under any
repartitioning, and identical pairs can never land in two splits. ``hash_split`` compares an md5 prefix
with fixed hex cuts (fixed-width lower-case hex compares like the number it encodes); ``row_hash_split``
takes the hash that pandas gives a row, so that a corpus is split as an eager pandas job would split it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalam.functions import text as T
from qalam.functions.pairhash import pair_hash, unit_interval

SPLITS = ("train", "val", "test")


def hex_cut(ratio: float) -> str | None:
    """Cut point on the 32-bit hash prefix for a cumulative ratio; None means 'everything'."""
    if ratio >= 1.0:
        return None
    return format(int(math.floor(ratio * 2**32)), "08x")


def split_hash(en: str = "en", ar: str = "ar") -> F.Column:
    return F.substring(F.md5(F.concat(F.col(en), F.lit("|"), F.col(ar))), 1, 8)


def hash_split(
    df: DataFrame, train_ratio: float = 0.90, val_ratio: float = 0.05, test_ratio: float = 0.05
) -> DataFrame:
    """Add ``split`` in {train, val, test} from a 32-bit hash of (en, ar)."""
    _check_shares(train_ratio, val_ratio, test_ratio)
    h = split_hash()
    train_cut, val_cut = hex_cut(train_ratio), hex_cut(train_ratio + val_ratio)
    is_train = F.lit(True) if train_cut is None else (h < F.lit(train_cut))
    is_val = F.lit(True) if val_cut is None else (h < F.lit(val_cut))
    return df.withColumn(
        "split", F.when(is_train, F.lit("train")).when(is_val, F.lit("val")).otherwise(F.lit("test"))
    )


def _check_shares(*shares: float) -> None:
    if not math.isclose(sum(shares), 1.0, abs_tol=1e-9):
        raise ValueError(f"train, val and test shares add up to {sum(shares)}, not to 1")


def row_hash_split(
    df: DataFrame, train_ratio: float = 0.90, val_ratio: float = 0.05, test_ratio: float = 0.05
) -> DataFrame:
    """Add ``split`` by the 64-bit hash of (en, ar) that pandas computes, as a share of 2**64."""
    _check_shares(train_ratio, val_ratio, test_ratio)
    placed = df.withColumn("_at", unit_interval(pair_hash("en", "ar")))
    at = F.col("_at")
    split = F.when(at < train_ratio, F.lit("train")).when(at < train_ratio + val_ratio, F.lit("val")).otherwise(F.lit("test"))
    return placed.withColumn("split", split).drop("_at")


def leakage_check(df: DataFrame, digest: Column | None = None) -> DataFrame:
    """Pairs that occur in more than one split (must be 0): one row ``leak_count``.

    What is shuffled is a 128-bit digest of a pair and its split; texts are compared only where a digest is
    in several splits. (``digest``: another one, for tests.)"""
    # null and empty texts are told apart, and so are the two texts of a pair
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in ("en", "ar")]
    key = F.unhex(F.md5(F.concat(*parts))) if digest is None else digest
    keyed = df.select("en", "ar", "split", key.alias("_key"))
    split_sets = keyed.groupBy("_key").agg((F.min("split") != F.max("split")).alias("_several")).where("_several").select("_key")
    suspects = keyed.join(split_sets, "_key", "left_semi")
    per_pair = suspects.groupBy("en", "ar").agg((F.min("split") != F.max("split")).alias("leaks"))
    return per_pair.agg(F.count_if("leaks").alias("leak_count"))


def assert_no_leakage(df: DataFrame) -> None:
    leaks = leakage_check(df).first()["leak_count"]
    if leaks:
        raise ValueError(f"{leaks} pairs are in more than one split")


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split and the share of all rows, to four digits."""
    c = df.groupBy("split").agg(F.count(F.lit(1)).cast("long").alias("rows"))
    # a three-row table: the total is a tiny grouping-set row joined back via a window
    from pyspark.sql import Window

    return c.select("split", "rows", F.bround(F.col("rows") / F.sum("rows").over(Window.partitionBy()), 4).alias("ratio"))


def direction_split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split", "direction").agg(F.count(F.lit(1)).cast("long").alias("rows"))


def bidirectional_expand(df: DataFrame, order_col: str = "row_id") -> DataFrame:
    """Each pair -> an en_to_ar row (row_id*2) and an ar_to_en row (row_id*2+1); one pass."""
    rid = F.col(order_col).cast("long")
    fwd = F.struct(
        (rid * 2).alias("row_id"),
        T.tag_source("en", T.EN_TO_AR).alias("source_text"),
        F.col("ar").alias("target_text"),
        F.lit(T.EN_TO_AR).alias("direction"),
        F.col("split").alias("split"),
    )
    bwd = F.struct(
        (rid * 2 + 1).alias("row_id"),
        T.tag_source("ar", T.AR_TO_EN).alias("source_text"),
        F.col("en").alias("target_text"),
        F.lit(T.AR_TO_EN).alias("direction"),
        F.col("split").alias("split"),
    )
    return df.select(F.explode(F.array(fwd, bwd)).alias("r")).select("r.*")


def split_views(df: DataFrame) -> dict[str, DataFrame]:
    """One filtered view per split (prunes partitions when the table is written by split)."""
    return {s: df.where(F.col("split") == s) for s in SPLITS}


def check_split_sizes(df: DataFrame) -> DataFrame:
    """The (split, rows) table of ``df``. Raises if one of the splits is empty, or if rows belong to
    none of them, so that the views of :func:`split_views` together would not hold every row."""
    counts = df.groupBy("split").agg(F.count(F.lit(1)).cast("long").alias("rows"))
    found = {r["split"]: r["rows"] for r in counts.collect()}
    empty = [s for s in SPLITS if not found.get(s)]
    if empty:
        raise ValueError(f"no rows in split {', '.join(empty)}")
    stray = sum(n for s, n in found.items() if s not in SPLITS)
    if stray:
        raise ValueError(f"{stray} rows are in none of the splits {', '.join(SPLITS)}")
    return counts
