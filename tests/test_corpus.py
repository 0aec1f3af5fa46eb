"""Corpus-build properties: one dedup equals three, cleaning is idempotent, results do not
depend on partitioning, the split is stable, expansion doubles rows."""

from pyspark.sql import functions as F

from qalam.operators import clean as C
from qalam.operators import split as SP
from qalam.plans import corpus as Q
from qalam.sources import fixtures as FX

SF001 = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_one_dedup_equals_funnel(spark):
    raw = FX.raw_pairs(spark, SF001)
    funnel = C.cleaning_funnel(raw).first()
    assert funnel["final"] == C.clean_pairs(raw).count()
    assert funnel["after_dedup"] == raw.select("en", "ar").distinct().count()
    assert funnel["merged"] == raw.count()
    assert funnel["swapped"] > 0 and funnel["diacritic_chars"] > 0


def test_cleaning_idempotent(spark):
    once = C.clean_pairs(FX.raw_pairs(spark, SF001))
    twice = C.clean_pairs(once)
    assert rows(once) == rows(twice)


def test_partition_independent(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(rows(Q.q_word_length_stats(spark, SF001)) + rows(Q.q_top_sentences(spark, SF001)))
        assert out[0] == out[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_split_stable_and_expand(spark):
    p = C.drop_blank_pairs(C.clean_pairs(FX.raw_pairs(spark, SF001)))
    a = rows(SP.hash_split(p).select("row_id", "split"))
    b = rows(SP.hash_split(p.repartition(7)).select("row_id", "split"))
    assert a == b
    assert SP.leakage_check(SP.hash_split(p)).first()["leak_count"] == 0
    bi = SP.bidirectional_expand(SP.hash_split(p))
    assert bi.count() == 2 * p.count()
    assert bi.where(F.col("direction") == "en_to_ar").where(~F.col("source_text").startswith("<2ar> ")).count() == 0


def test_split_ratio_check(spark):
    import pytest

    with pytest.raises(ValueError):
        SP.hash_split(FX.raw_pairs(spark, SF001), 0.9, 0.05, 0.06)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["metric", "count", "ratio"]
    assert df.count() == 2
    assert set(E.oracle_sql()) <= set(E.queries())


def test_blank_filter_starts_from_the_written_corpus(spark):
    """Filters on the cleaned texts aren't pushed below the cleaning, and its result is read by columns."""
    from qalam.plans import corpus as Q

    d = "/root/testdata/sf0.001"
    assert Q.cleaned_stage(spark, d).inputFiles()
    plan = Q.q_drop_blank_pairs(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "translate" not in plan


def test_truncation_counts_words_of_texts_that_may_have_enough(spark):
    from qalam.operators import profile as P

    rows = [("a b c", "a b c d"), ("  a   b   c  ", "aaaa bbbb cccc dddd e"), ("aaaaaaaaaa", None)]
    got = {r.metric: r["count"] for r in P.truncation_estimate(spark.createDataFrame(rows, "en string, ar string"), 3).collect()}
    assert got == {"en_gt_max_len": 0, "ar_gt_max_len": 2, "either_side_gt_max_len": 2}
