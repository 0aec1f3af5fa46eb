"""Reading the given tables and writing stage boundaries, shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qalam.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) alone, so that no other column can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def held(value: Column) -> Column:
    """``value``, computed in this projection alone. An expression with a row number is never copied
    into filters or projections above, where array functions would compute it for every element."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


#: Rows of a file where a staged table's rows are counted.
ROWS_PER_FILE = 200_000


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back: later stages
    start from the files, so a lost executor recomputes nothing before them. With about how many
    ``rows`` it has, it gets files of a good size, and no more shuffle files follow from it than need be."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(1, math.ceil(rows / ROWS_PER_FILE)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
