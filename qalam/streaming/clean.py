"""Apply the per-row cleaning to a streaming source of pairs.

Everything in :func:`qalam.operators.clean.clean_rows` is a narrow, stateless expression, so it
runs unchanged on a streaming DataFrame. Dedup across micro-batches is left to the batch job
(``dedup_pairs``) on the written table: unbounded streaming dedup state would grow with the
corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as Ty

from qalam.operators.clean import clean_rows

PAIR_STREAM_SCHEMA = Ty.StructType(
    [Ty.StructField("row_id", Ty.LongType()), Ty.StructField("en", Ty.StringType()), Ty.StructField("ar", Ty.StringType())]
)


def read_pair_stream(spark: SparkSession, path: str, schema: Ty.StructType = PAIR_STREAM_SCHEMA, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).load(path)


def clean_stream(stream: DataFrame) -> DataFrame:
    return clean_rows(stream)


def write_clean_stream(stream: DataFrame, out_path: str, checkpoint_path: str, available_now: bool = True):
    """Append cleaned rows to Parquet with a checkpointed query; returns the query handle."""
    w = clean_stream(stream).writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint_path).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
