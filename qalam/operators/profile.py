"""Corpus profiles: duplicate stats, null/blank counts, length distributions, script anomalies,
truncation proxy, frequent sentences.

Length percentiles are exact (linear interpolation, like pandas) but never sort the corpus:
lengths are small integers, so each side is reduced to a ``(length, count)`` histogram with a
partial+final aggregate and ``percentile(len, p, count)`` runs over that tiny table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalam.functions import text as T

SIDES = ("en", "ar")
PCTS = (("p50", 0.50), ("p90", 0.90), ("p95", 0.95), ("p99", 0.99))


def _stack_sides(df: DataFrame, fn) -> DataFrame:
    """(side, value) for both columns in one pass (no second scan)."""
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(s).alias("side"), fn(s).alias("v")) for s in SIDES])
        ).alias("s")
    ).select("s.side", "s.v")


def _metric_table(per_side: DataFrame, metrics: list[str]) -> DataFrame:
    """(side, m1, m2, ...) -> rows (metric, en, ar)."""
    stack = ", ".join(f"'{m}', {m}" for m in metrics)
    long = per_side.select("side", F.expr(f"stack({len(metrics)}, {stack}) as (metric, value)"))
    return (
        long.groupBy("metric")
        .agg(*[F.max(F.when(F.col("side") == s, F.col("value"))).alias(s) for s in SIDES])
        .select("metric", *[F.col(s).cast("double").alias(s) for s in SIDES])
    )


def length_histogram(df: DataFrame, fn) -> DataFrame:
    return _stack_sides(df, fn).groupBy("side", F.col("v").alias("len")).agg(F.count(F.lit(1)).alias("cnt"))


def _length_stats(df: DataFrame, fn, with_max: bool, digits: int = 2) -> DataFrame:
    hist = length_histogram(df, fn)
    aggs = [(F.sum(F.col("len") * F.col("cnt")) / F.sum("cnt")).alias("mean")]
    aggs += [F.percentile("len", p, F.col("cnt")).alias(name) for name, p in PCTS]
    names = ["mean"] + [n for n, _ in PCTS]
    if with_max:
        aggs.append(F.max("len").cast("double").alias("max"))
        names.append("max")
    per_side = hist.groupBy("side").agg(*aggs)
    out = _metric_table(per_side, names)
    if digits is not None:
        out = out.select("metric", *[F.bround(s, digits).alias(s) for s in SIDES])
    return out


def word_length_stats(df: DataFrame, digits: int | None = 2) -> DataFrame:
    """Whitespace word counts per row: mean, p50, p90, p95, p99 (rows: metric, en, ar)."""
    return _length_stats(df, T.word_count, with_max=False, digits=digits)


def char_length_stats(df: DataFrame, digits: int | None = 2) -> DataFrame:
    """Code-point lengths per row: mean, p50-p99, max (rows: metric, en, ar)."""
    return _length_stats(df, T.char_count, with_max=True, digits=digits)


def pair_duplicate_stats(df: DataFrame) -> DataFrame:
    """total, unique pairs, duplicates and ratio (0 when empty); nulls compare equal."""
    g = df.groupBy("en", "ar").agg(F.count(F.lit(1)).alias("n"))
    s = g.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"), F.count(F.lit(1)).cast("long").alias("unique_pairs"))
    dup = F.col("total") - F.col("unique_pairs")
    return s.select(
        "total",
        "unique_pairs",
        dup.alias("duplicate_pairs"),
        F.when(F.col("total") > 0, dup / F.col("total")).otherwise(F.lit(0.0)).alias("duplicate_ratio"),
    )


def null_empty_profile(df: DataFrame) -> DataFrame:
    """Per column: null count and blank count (null or whitespace only)."""
    aggs = []
    for s in SIDES:
        aggs.append(F.sum(F.col(s).isNull().cast("long")).alias(f"{s}_null"))
        aggs.append(F.sum((T.strip_text(T.fill_text(s)) == "").cast("long")).alias(f"{s}_empty"))
    wide = df.agg(*aggs)
    return wide.select(
        F.expr(
            "stack(2, 'en', coalesce(en_null, 0L), coalesce(en_empty, 0L), "
            "'ar', coalesce(ar_null, 0L), coalesce(ar_empty, 0L)) "
            "as (`column`, null_count, empty_or_whitespace_count)"
        )
    )


def unique_sentence_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct non-null texts per column and the ratio to the pair count."""
    if approx:
        d = [F.approx_count_distinct(s).alias(f"{s}_u") for s in SIDES]
    else:
        d = [F.count_distinct(s).alias(f"{s}_u") for s in SIDES]
    wide = df.agg(F.count(F.lit(1)).alias("n"), *d)
    rows = wide.select(
        "n", F.expr("stack(2, 'en', en_u, 'ar', ar_u) as (`column`, unique_count)")
    )
    return rows.select(
        "column",
        F.col("unique_count").cast("long").alias("unique_count"),
        F.when(F.col("n") > 0, F.col("unique_count") / F.col("n")).alias("unique_ratio"),
    )


def length_outliers(df: DataFrame, order_col: str = "row_id", preview_chars: int = 200) -> DataFrame:
    """Longest text per side: side, row_id, char_len, first ``preview_chars`` characters.

    Ties go to the first row (smallest ``order_col``): ``max_by`` on (len, -row_id). One pass without
    a grouping key, so nothing is sorted or exploded before the aggregate.
    """
    row_id = F.col(order_col).cast("long")
    best = df.agg(
        *(
            F.max_by(
                F.struct(
                    F.lit(s).alias("side"),
                    row_id.alias("row_id"),
                    T.char_count(s).alias("char_len"),
                    F.substring(T.fill_text(s), 1, preview_chars).alias("text"),
                ),
                F.struct(T.char_count(s).alias("n"), (-row_id).alias("r")),
            ).alias(s)
            for s in SIDES
        )
    )
    return best.select(F.explode(F.array(*SIDES)).alias("b")).where("b IS NOT NULL").select("b.*")


def script_anomalies(df: DataFrame) -> DataFrame:
    """Rows whose ``en`` holds Arabic / whose ``ar`` holds Latin: count and ratio."""
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(T.has_arabic(T.fill_text("en")).cast("long")).alias("a"),
        F.sum(T.has_latin(T.fill_text("ar")).cast("long")).alias("b"),
    )
    rows = wide.select(
        "n", F.expr("stack(2, 'en_contains_arabic', coalesce(a, 0L), 'ar_contains_latin', coalesce(b, 0L)) as (metric, count)")
    )
    return rows.select(
        "metric",
        F.col("count").cast("long").alias("count"),
        F.when(F.col("n") > 0, F.col("count") / F.col("n")).alias("ratio"),
    )


def truncation_estimate(df: DataFrame, max_seq_len: int = 128) -> DataFrame:
    """Rows whose whitespace word count exceeds ``max_seq_len``: en, ar, either."""
    # more than n words have at least n + 1 characters and n spaces: words of shorter texts need no count
    e, a = ((T.char_count(s) > 2 * max_seq_len) & (T.word_count(s) > max_seq_len) for s in SIDES)
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e.cast("long")).alias("e"),
        F.sum(a.cast("long")).alias("a"),
        F.sum((e | a).cast("long")).alias("x"),
    )
    rows = wide.select(
        "n",
        F.expr(
            "stack(3, 'en_gt_max_len', coalesce(e, 0L), 'ar_gt_max_len', coalesce(a, 0L), "
            "'either_side_gt_max_len', coalesce(x, 0L)) as (metric, count)"
        ),
    )
    return rows.select(
        "metric",
        F.col("count").cast("long").alias("count"),
        F.when(F.col("n") > 0, F.col("count") / F.col("n")).otherwise(F.lit(0.0)).alias("ratio"),
    )


def frame_shape(df: DataFrame, text_cols: tuple[str, ...] = SIDES) -> DataFrame:
    """Row count, column count and UTF-8 text bytes (the reference reports Python object memory,
    which has no distributed meaning; bytes of text are the comparable size)."""
    nbytes = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in text_cols), F.lit(0).cast("long"))
    return df.agg(
        F.count(F.lit(1)).cast("long").alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        F.coalesce(F.sum(nbytes), F.lit(0)).cast("long").alias("text_bytes"),
    )


def top_sentences(df: DataFrame, n: int = 10) -> DataFrame:
    """``n`` most frequent texts per side (blanks counted, nulls as ""); ties by text.

    Each side is its own partial+final count and a TakeOrdered top-n (no single-task window).
    """
    parts = []
    for s in SIDES:
        counts = df.groupBy(T.fill_text(s).alias("text")).agg(F.count(F.lit(1)).cast("long").alias("count"))
        parts.append(
            counts.orderBy(F.desc("count"), F.asc("text")).limit(n).select(F.lit(s).alias("side"), "text", "count")
        )
    return parts[0].unionByName(parts[1])


def rows_by_source(df: DataFrame, source_col: str = "source") -> DataFrame:
    """Rows per source plus the merged total (``source`` null)."""
    return df.rollup(source_col).agg(F.count(F.lit(1)).cast("long").alias("rows")).select(
        F.col(source_col).alias("source"), "rows"
    )


def format_ratio(c: Column | str, digits: int = 4) -> Column:
    """ratio -> percent text with ``digits`` decimals, trailing zeros trimmed, e.g. '3.3865%'.

    Printed through a decimal so small values never show an exponent ('0.0022%', not '2.2E-3%').
    """
    col = F.col(c) if isinstance(c, str) else c
    d = F.bround(col * 100, digits).cast(f"decimal(38,{digits})").cast("string")
    trimmed = F.regexp_replace(d, "0+$", "")
    trimmed = F.regexp_replace(trimmed, r"\.$", ".0")
    return F.concat(trimmed, F.lit("%"))
