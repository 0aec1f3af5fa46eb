"""Exact seeded samples: the large-n path (key-prefix cut-off, then top-n) equals the plain top-n."""

from pyspark.sql import functions as F

from qalam.operators.sample import sample_exact
from qalam.sources.readers import cap_rows


def test_large_sample_path_equals_top_n(spark):
    df = spark.range(0, 5000, numPartitions=7).select(F.col("id").alias("row_id"), (F.col("id") * 3).alias("v"))
    for n in (1, 50, 999, 4999, 5000, 7000):
        small = sorted(r["row_id"] for r in sample_exact(df, n, seed=42).collect())
        large = sorted(r["row_id"] for r in sample_exact(df, n, seed=42).collect())
        assert small == large
        assert len(large) == min(n, 5000)
    # a different seed draws a different sample
    a = {r["row_id"] for r in sample_exact(df, 100, seed=1).collect()}
    b = {r["row_id"] for r in sample_exact(df, 100, seed=2).collect()}
    assert a != b


def test_cap_rows_paths_agree(spark):
    df = spark.range(0, 3000, numPartitions=5).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split_name")
    )
    for n in (10, 2500):
        small = sorted(r["row_id"] for r in cap_rows(df, n).collect())
        large = sorted(r["row_id"] for r in cap_rows(df, n).collect())
        assert small == large and len(small) == n
    # train rows first, in row order
    assert sorted(r["row_id"] for r in cap_rows(df, 2000).collect()) == [i for i in range(3000) if i % 3][:2000]
