"""Registered source/sink round trips: written to the session's shared checkpoint folder and
read back, so the read-back rows are compared with the oracle."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from qalam.operators import runlog as L
from qalam.plans.corpus import cleaned_once, cleaned_stage
from qalam.session import scratch_path
from qalam.sources import fixtures as FX
from qalam.sources import readers as R
from qalam.sources import sinks as K

LOG_SCHEMA = "run_id long, step long, ingest_seq long, val_loss double, bleu double, chrf double, comet double"


def q_write_pairs(spark, d):
    base = scratch_path(spark, "pairs")
    K.write_pairs(cleaned_once(spark, d).select("row_id", "en", "ar"), f"{base}/parquet", f"{base}/csv")
    return R.read_pairs_parquet(spark, f"{base}/parquet")


def q_read_pairs_csv(spark, d):
    base = scratch_path(spark, "pairs-csv")
    K.write_pairs(cleaned_stage(spark, d).select("row_id", "en", "ar"), f"{base}/parquet", f"{base}/csv")
    return R.read_pairs_csv(spark, f"{base}/csv", schema="row_id long, en string, ar string")


def q_write_metric_log(spark, d):
    path = scratch_path(spark, "metric-log")
    log = FX.metric_log(spark, d)
    # two appends (the second re-ingests a slice with later sequence numbers)
    K.write_metric_log(log.where(F.col("ingest_seq") % 2 == 0), path)
    K.write_metric_log(log.where(F.col("ingest_seq") % 2 == 1), path)
    back = spark.read.parquet(path)
    return L.upsert_metric_log(back.select("run_id", "step", "ingest_seq", "val_loss", "bleu", "chrf", "comet"))


def q_read_metric_log(spark, d):
    """A log whose file has its columns in another order, and more of them, and one that is absent."""
    schema = Ty.StructType.fromDDL(LOG_SCHEMA)
    path = scratch_path(spark, "metric-csv")
    log = FX.metric_log(spark, d)
    log.select(*sorted(log.columns)).write.option("header", True).csv(path)
    missing = R.read_metric_log(spark, scratch_path(spark, "absent") + "/eval_metrics.csv", schema)
    return missing.unionByName(R.read_metric_log(spark, path, schema))


QUERIES = {
    "write_pairs": q_write_pairs,
    "read_pairs_parquet": q_write_pairs,
    "read_pairs_csv": q_read_pairs_csv,
    "write_metric_log": q_write_metric_log,
    "read_metric_log": q_read_metric_log,
}
