"""Pair cleaning: swap repair, boundary markers, diacritics, whitespace, dedup, funnel counters.

Inputs are ``(row_id, en, ar)`` frames; ``row_id`` encodes the original row order, so "keep the
first duplicate" is ``min(row_id)`` per key -- a hash aggregate with map-side partial
aggregation, which also absorbs hot keys (one pair holding a third of all rows collapses to
one row per map task before the exchange).

Every cleaning step is a deterministic per-row function and the dedup key is the whole row,
so ``distinct(f(distinct(x))) == distinct(f(x))``: :func:`clean_pairs` needs a single exchange
where the reference dedups three times. Only the funnel counters need the intermediate
distinct sets (:func:`cleaning_funnel`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalam.functions import text as T

KEY = ["en", "ar"]


def dedup_pairs(df: DataFrame, order_col: str = "row_id", keys: list[str] | None = None) -> DataFrame:
    """Distinct on ``keys`` (default en, ar) keeping the first row by ``order_col``.

    Nulls compare equal, as in pandas. Other columns are taken from the kept row.
    """
    keys = keys or KEY
    others = [c for c in df.columns if c not in keys and c != order_col]
    if not others:
        return df.groupBy(*keys).agg(F.min(order_col).alias(order_col)).select(*df.columns)
    kept = F.min(F.struct(F.col(order_col), *[F.col(c) for c in others])).alias("_kept")
    out = df.groupBy(*keys).agg(kept)
    return out.select(*keys, *[F.col(f"_kept.{c}").alias(c) for c in [order_col, *others]]).select(*df.columns)


def fill_pairs(df: DataFrame) -> DataFrame:
    """``fill_text`` on both columns (null -> "")."""
    return df.withColumns({"en": T.fill_text("en"), "ar": T.fill_text("ar")})


def script_flags(df: DataFrame) -> DataFrame:
    """Four script flags per row, evaluated on null-filled text."""
    e, a = T.fill_text("en"), T.fill_text("ar")
    return df.withColumns(
        {
            "en_has_arabic": T.has_arabic(e),
            "en_has_latin": T.has_latin(e),
            "ar_has_arabic": T.has_arabic(a),
            "ar_has_latin": T.has_latin(a),
        }
    )


def swap_fix(df: DataFrame) -> DataFrame:
    """Exchange ``en``/``ar`` on rows flagged by the swap mask (raw values, nulls kept)."""
    m = T.swap_mask("en", "ar")
    cols = []
    for c in df.columns:
        if c == "en":
            cols.append(F.when(m, F.col("ar")).otherwise(F.col("en")).alias("en"))
        elif c == "ar":
            cols.append(F.when(m, F.col("en")).otherwise(F.col("ar")).alias("ar"))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def swap_preview(df: DataFrame, n: int = 10, order_col: str = "row_id") -> DataFrame:
    """First ``n`` flagged rows (before the swap) in row order; TakeOrdered, no global sort."""
    return df.where(T.swap_mask("en", "ar")).orderBy(order_col).limit(n)


def clean_boundaries(df: DataFrame) -> DataFrame:
    """Boundary-marker cleaning on both columns; nulls become ""."""
    return df.withColumns({"en": T.clean_boundaries("en"), "ar": T.clean_boundaries("ar")})


def clean_boundaries_stats(df: DataFrame) -> DataFrame:
    """Rows whose text changed per column (one row: ``en_changed, ar_changed``)."""
    e, a = T.fill_text("en"), T.fill_text("ar")
    return df.agg(
        F.sum((e != T.clean_boundaries("en")).cast("long")).alias("en_changed"),
        F.sum((a != T.clean_boundaries("ar")).cast("long")).alias("ar_changed"),
    ).select(F.coalesce("en_changed", F.lit(0)).alias("en_changed"), F.coalesce("ar_changed", F.lit(0)).alias("ar_changed"))


def strip_diacritics(df: DataFrame) -> DataFrame:
    return df.withColumn("ar", T.strip_diacritics(T.fill_text("ar")))


def diacritic_stats(df: DataFrame) -> DataFrame:
    """Diacritic characters and rows changed in ``ar`` (one row)."""
    a = T.fill_text("ar")
    n = T.count_diacritics(a)
    return df.agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("diacritic_chars"),
        F.coalesce(F.sum((n > 0).cast("long")), F.lit(0)).alias("diacritic_rows"),
    )


def collapse_whitespace(df: DataFrame) -> DataFrame:
    """Whitespace runs -> one space, stripped; ``ar`` only, as in the reference."""
    return df.withColumn("ar", T.collapse_whitespace(T.fill_text("ar")))


def clean_rows(df: DataFrame) -> DataFrame:
    """Per-row cleaning without dedup: swap -> boundaries -> diacritics -> whitespace.

    Staged projections with column references (not one nested expression): the swap mask is
    evaluated once per row and each generated method stays small enough for codegen. Narrow,
    so it also applies to streaming frames.
    """
    others = [c for c in df.columns if c not in KEY]
    flagged = df.withColumn("_swap", T.swap_mask("en", "ar"))
    swapped = flagged.select(
        *others,
        F.when(F.col("_swap"), F.col("ar")).otherwise(F.col("en")).alias("en"),
        F.when(F.col("_swap"), F.col("en")).otherwise(F.col("ar")).alias("ar"),
    )
    bounded = swapped.select(*others, T.clean_boundaries("en").alias("en"), T.clean_boundaries("ar").alias("ar"))
    return bounded.select(*others, "en", T.strip_diacritics_and_collapse("ar").alias("ar")).select(*df.columns)


def clean_pairs(df: DataFrame, order_col: str = "row_id") -> DataFrame:
    """Full corpus cleaning with a single dedup exchange; keeps the first row per final pair."""
    return dedup_pairs(clean_rows(df), order_col=order_col)


def drop_blank_pairs(df: DataFrame) -> DataFrame:
    """Stage-2 row filter: drop nulls, strip both sides, drop rows blank on either side."""
    nonblank = (T.strip_text("en") != "") & (T.strip_text("ar") != "")
    return df.dropna(subset=KEY).where(nonblank).withColumns({"en": T.strip_text("en"), "ar": T.strip_text("ar")})


def cleaning_funnel(df: DataFrame) -> DataFrame:
    """Rows after each stage of the reference's three-dedup chain (one output row).

    Three aggregations on progressively smaller inputs: raw pair -> swapped pair -> final
    pair. Each is a partial+final hash aggregate, so duplicated keys shrink map-side.
    Diacritics are counted over the swap-deduplicated rows after boundary cleaning, exactly
    where the reference counts them.
    """
    merged = df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    flagged = merged.select(*KEY, "n", T.swap_mask("en", "ar").cast("long").alias("is_swap"))
    swapped = swap_fix(flagged).groupBy(*KEY).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("raw_groups"), F.sum("is_swap").alias("is_swap")
    )
    e0, a0 = T.fill_text("en"), T.fill_text("ar")
    eb, ab = T.clean_boundaries("en"), T.clean_boundaries("ar")
    staged = swapped.select(
        "n",
        "raw_groups",
        "is_swap",
        (e0 != eb).cast("long").alias("en_changed"),
        (a0 != ab).cast("long").alias("ar_changed"),
        T.count_diacritics(ab).cast("long").alias("diac"),
        eb.alias("en"),
        T.strip_diacritics_and_collapse(ab).alias("ar"),
    )
    finals = staged.groupBy(*KEY).agg(
        F.sum("n").alias("n"),
        F.sum("raw_groups").alias("raw_groups"),
        F.sum("is_swap").alias("is_swap"),
        F.count(F.lit(1)).alias("swap_groups"),
        F.sum("en_changed").alias("en_changed"),
        F.sum("ar_changed").alias("ar_changed"),
        F.sum("diac").alias("diac"),
        F.sum((F.col("diac") > 0).cast("long")).alias("diac_rows"),
    )
    z = F.lit(0)
    tot = finals.agg(
        F.coalesce(F.sum("n"), z).cast("long").alias("merged"),
        F.coalesce(F.sum("raw_groups"), z).cast("long").alias("after_dedup"),
        F.coalesce(F.sum("is_swap"), z).cast("long").alias("swapped"),
        F.coalesce(F.sum("swap_groups"), z).cast("long").alias("after_swap_dedup"),
        F.coalesce(F.sum("en_changed"), z).cast("long").alias("dash_newline_en"),
        F.coalesce(F.sum("ar_changed"), z).cast("long").alias("dash_newline_ar"),
        F.coalesce(F.sum("diac"), z).cast("long").alias("diacritic_chars"),
        F.coalesce(F.sum("diac_rows"), z).cast("long").alias("diacritic_rows"),
        F.count(F.lit(1)).cast("long").alias("final"),
    )
    return tot.select(
        "merged",
        "after_dedup",
        "swapped",
        (F.col("after_dedup") - F.col("after_swap_dedup")).alias("removed_after_swap"),
        "dash_newline_en",
        "dash_newline_ar",
        "diacritic_chars",
        "diacritic_rows",
        (F.col("after_swap_dedup") - F.col("final")).alias("removed_after_diacritics"),
        "final",
    )
