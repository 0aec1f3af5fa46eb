"""Sinks: cleaned corpus (Parquet + CSV), small profile tables, one-object JSON metadata,
append-only metric logs and the test-metric record.

Large outputs are written by the executors in parallel; only the small profile tables (a few
rows by construction) are coalesced to one file each.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from qalam.session import dropping_shuffles


def write_pairs(df: DataFrame, parquet_path: str, csv_path: str | None = None, partition_by: list[str] | None = None) -> None:
    """Cleaned pairs to Parquet (optionally partitioned, e.g. by ``split`` for pruning) and CSV, which is
    written from the Parquet files, so that ``df`` is computed once and its shuffle files are gone by then."""
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with dropping_shuffles(df.sparkSession):
        w.parquet(parquet_path)
    if csv_path is not None:
        written = df.sparkSession.read.schema(df.schema).parquet(parquet_path).select(*df.columns)
        written.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(csv_path)


def write_profile_tables(tables: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Each small profile table as one headed CSV file under ``out_dir/<name>``."""
    paths = {}
    for name, t in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        t.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        paths[name] = path
    return paths


def metadata_frame(spark: SparkSession, record: dict) -> DataFrame:
    """One-row DataFrame from a flat dict; lists become arrays (e.g. ``adam_betas``)."""
    return spark.read.json(spark.sparkContext.parallelize([json.dumps(record, ensure_ascii=False)]))


def write_json_metadata(spark: SparkSession, record: dict | DataFrame, path: str) -> None:
    """Summary / metadata / run-config object as one JSON line."""
    df = record if isinstance(record, DataFrame) else metadata_frame(spark, record)
    df.coalesce(1).write.mode("overwrite").json(path)


def write_metric_log(df: DataFrame, path: str, run_col: str = "run_id") -> None:
    """Append log rows (Parquet, partitioned by run); ``upsert_metric_log`` gives the current view."""
    df.write.mode("append").partitionBy(run_col).parquet(path)


def export_test_metrics(record: DataFrame, json_path: str, csv_path: str) -> DataFrame:
    """Test metric row with numeric columns cast to double, written as JSON and CSV."""
    numeric = (Ty.IntegerType, Ty.LongType, Ty.FloatType, Ty.DoubleType, Ty.DecimalType, Ty.ShortType)
    out = record.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, numeric) else F.col(f.name) for f in record.schema.fields]
    )
    out.coalesce(1).write.mode("overwrite").json(json_path)
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(csv_path)
    return out
