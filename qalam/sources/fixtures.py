"""Test inputs derived from the driver's read-only tables (see FIXTURES.md).

The reference's own corpora are not shipped, so a dirty parallel corpus is derived from
``documents``: one row per non-empty line, a letter-for-letter Arabic transliteration as the
"translation", and injected defects (dashes, literal backslash-n, diacritics, swaps, nulls,
blanks). Everything is plain DataFrame work, so it scales with the input table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture definition (FIXTURES.md B1/B2)
LATIN_LOWER = "abcdefghijklmnopqrstuvwxyz"
ARABIC_LETTERS = "ابتثجحخدذرزسشصضطظعغفقكلمنه"
ALEF = "ا"
FATHA = "َ"
SOURCE_COLUMNS = [
    ("English", "Arabic"),
    ("caption", "caption_multi"),
    ("en", "ar"),
    ("sentence", "translation"),
    ("english", "arabic"),
]
SOURCE_NAMES = ["local_25k", "ds2", "ds3", "ds4", "ds5"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no, line) for every line of every document."""
    from qalam.session import balance

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return balance(out.withColumn("line_no", F.col("line_no").cast("long")))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty parallel corpus ``(doc_id, line_no, src, k, en, ar)``; ``k`` is the row key."""
    k = (
        lines(spark, sf_dir)
        .where(F.col("line") != "")
        .select(
            "doc_id",
            "line_no",
            "line",
            (F.col("doc_id") * 1000 + F.col("line_no")).alias("k"),
            ((F.col("doc_id") * 7 + F.col("line_no")) % 5).alias("src"),
            F.translate(F.lower("line"), LATIN_LOWER, ARABIC_LETTERS).alias("a0"),
        )
    )
    kk = F.col("k")
    e = F.when(kk % 13 == 0, F.concat(F.lit("- "), F.col("line"))).otherwise(F.col("line"))
    a = (
        F.when(kk % 17 == 0, F.concat(F.col("a0"), F.lit(" \\n")))
        .when(kk % 5 == 0, F.regexp_replace("a0", ALEF, ALEF + FATHA))
        .otherwise(F.col("a0"))
    )
    p = k.select("doc_id", "line_no", "src", "k", e.alias("e"), a.alias("a"))
    en = F.when(kk % 101 == 0, F.lit(None).cast("string")).when(kk % 97 == 0, F.col("a")).otherwise(F.col("e"))
    ar = F.when(kk % 103 == 0, F.lit("  ")).when(kk % 97 == 0, F.col("e")).otherwise(F.col("a"))
    return p.select("doc_id", "line_no", "src", "k", en.alias("en"), ar.alias("ar"))


def raw_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pairs`` reduced to the operator input shape ``(row_id, en, ar)``."""
    return pairs(spark, sf_dir).select(F.col("k").alias("row_id"), "en", "ar")


def split_name_col() -> F.Column:
    return F.when(F.col("doc_id") % 4 > 0, F.lit("train")).otherwise(F.lit("test"))


def source_frames(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Five differently named sources (FIXTURES.md B2).

    Each frame keeps ``split_name`` and a ``row_id`` whose order is the source's row order
    (split rank, doc_id, line_no); ``k`` stays unique across sources.
    """
    p = pairs(spark, sf_dir).withColumn("split_name", split_name_col())
    out = []
    for i, (en_name, ar_name) in enumerate(SOURCE_COLUMNS):
        out.append(
            (
                SOURCE_NAMES[i],
                p.where(F.col("src") == i).select(
                    "split_name",
                    F.col("k").alias("row_id"),
                    F.col("en").alias(en_name),
                    F.col("ar").alias(ar_name),
                ),
            )
        )
    return out


def cleaned_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qalam.operators.clean import clean_pairs

    return clean_pairs(raw_pairs(spark, sf_dir))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric-log rows from ``events`` (FIXTURES.md B4): a few ingests per (run, step), steps and keys
    that grow with the table, all nine metrics."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        (F.col("user_id") % 5).alias("run_id"),
        (F.floor(F.col("event_id") / 10) * 40).alias("step"),
        F.col("event_id").alias("ingest_seq"),
        (F.col("value") / 50).alias("val_loss"),
        (F.col("value") % 11).alias("val_ppl"),
        (F.col("value") % 30).alias("bleu"),
        (F.col("value") % 7 * 10).alias("chrf"),
        F.when(F.col("event_id") % 3 > 0, F.col("value") % 1).alias("comet"),
        (F.col("value") % 13).alias("bleu_en_to_ar"),
        (F.col("value") % 17).alias("bleu_ar_to_en"),
        (F.col("value") % 19).alias("chrf_en_to_ar"),
        (F.col("value") % 23).alias("chrf_ar_to_en"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, direction, source_text, target_text, prediction)`` on the test split (B3)."""
    from qalam.plans.corpus import bidir

    return predictions_from(bidir(spark, sf_dir))


def predictions_from(bi: DataFrame) -> DataFrame:
    """Deterministic stand-in predictions over bidirectional rows: exact, 80 % prefix, one word
    dropped, or the untranslated source (by ``(row_id // 2) % 4``)."""
    bi = bi.where(F.col("split") == "test")
    k = F.floor(F.col("row_id") / 2)
    ref = F.col("target_text")
    src_untagged = F.expr("substring(source_text, 7)")
    cut = F.expr("substring(target_text, 1, cast(floor(char_length(target_text) * 0.8) as int))")
    pred = (
        F.when(k % 4 == 0, ref)
        .when(k % 4 == 1, cut)
        .when(k % 4 == 2, F.replace(ref, F.lit(" the "), F.lit(" ")))
        .otherwise(src_untagged)
    )
    return bi.select("row_id", "direction", "source_text", "target_text", pred.alias("prediction"))


__all__ = [
    "table",
    "lines",
    "pairs",
    "raw_pairs",
    "source_frames",
    "cleaned_pairs",
    "metric_log",
    "predictions",
]
