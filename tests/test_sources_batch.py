"""Sources, sinks and batching."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from qalam.operators import batch as B
from qalam.sources import readers as R
from qalam.sources import sinks as K


def test_pick_column():
    assert R.pick_column(["English", "caption"], None, R.EN_CANDIDATES, "x") == "caption"
    assert R.pick_column(["a", "b"], "b", R.AR_CANDIDATES, "x") == "b"
    with pytest.raises(ValueError):
        R.pick_column(["a"], "b", R.AR_CANDIDATES, "x")
    with pytest.raises(ValueError):
        R.pick_column(["a"], None, R.AR_CANDIDATES, "x")


def test_require_columns(spark):
    df = spark.createDataFrame([("a",)], "en string")
    with pytest.raises(ValueError):
        R.require_columns(df)


def test_csv_roundtrip_na(spark, tmp_path):
    p = tmp_path / "pairs.csv"
    p.write_text('en,ar\n"hello, ""world""",مرحبا\nNA,x\n"multi\nline",y\n,z\n', encoding="utf-8")
    got = [tuple(r) for r in R.read_pairs_csv(spark, str(p)).collect()]
    assert got == [('hello, "world"', "مرحبا"), (None, "x"), ("multi\nline", "y"), (None, "z")]


def test_metric_log_missing(spark, tmp_path):
    from pyspark.sql import types as Ty

    schema = Ty.StructType.fromDDL("step long, val_loss double")
    assert R.read_metric_log(spark, str(tmp_path / "absent.csv"), schema).count() == 0


def test_sinks_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "ب", "train"), (2, "c", "د", "test")], "row_id long, en string, ar string, split string")
    K.write_pairs(df, str(tmp_path / "pq"), str(tmp_path / "csv"), partition_by=["split"])
    back = spark.read.parquet(str(tmp_path / "pq"))
    assert sorted(back.select("row_id").toPandas()["row_id"]) == [1, 2]
    assert back.where("split = 'test'").count() == 1
    K.write_json_metadata(spark, {"rows": 2, "adam_betas": [0.9, 0.98]}, str(tmp_path / "meta"))
    meta = spark.read.json(str(tmp_path / "meta")).first()
    assert meta["rows"] == 2 and list(meta["adam_betas"]) == [0.9, 0.98]
    rec = spark.createDataFrame([("r1", 9600, 1.5)], "run_id string, num_samples int, bleu double")
    out = K.export_test_metrics(rec, str(tmp_path / "tj"), str(tmp_path / "tc"))
    assert dict(out.dtypes)["num_samples"] == "double"


def test_global_index_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    got = B.global_index(df, ["k"], num_partitions=7).select("k", "_pos")
    ref = df.select("k", (F.row_number().over(Window.orderBy("k")) - 1).alias("_pos"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))


def test_assign_and_pad(spark):
    df = spark.createDataFrame(
        [(i, list(range(i % 5 + 1)), [1] * (i % 5 + 1), list(range(i % 3 + 1))) for i in range(10)],
        "row_id long, input_ids array<int>, attention_mask array<int>, labels array<int>",
    )
    b = B.assign_batches(df, 4, ["row_id"])
    assert sorted(r["batch_id"] for r in b.select("batch_id").distinct().collect()) == [0, 1, 2]
    p = B.pad_batches(b).collect()
    for r in p:
        assert len(r["input_ids"]) == r["input_len"] == len(r["attention_mask"])
        assert len(r["labels"]) == r["label_len"]
    r0 = [r for r in p if r["row_id"] == 0][0]
    assert r0["input_ids"][1:] == [0] * (r0["input_len"] - 1) and r0["labels"][1:] == [-100] * (r0["label_len"] - 1)


def test_batches_stay_inside_splits_and_pad_to_batch_max(spark):
    import math

    from pyspark.sql import functions as F

    from qalam.operators import batch as B

    rows = [(i, ("train", "val", "test")[i % 3 if i < 200 else 0], [1] * (1 + i % 11), [2] * (1 + i % 7)) for i in range(260)]
    df = spark.createDataFrame(rows, "row_id long, split string, input_ids array<int>, labels array<int>").withColumn(
        "attention_mask", F.transform("input_ids", lambda x: F.lit(1))
    )
    b = B.assign_batches(df, 24, ["row_id"], group_cols=["split"])
    per = {r["split"]: r for r in b.groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("batch_id").alias("nb"), F.min("pos").alias("p0"), F.max("batch_id").alias("bmax")).collect()}
    for split, r in per.items():
        assert r["p0"] == 0 and r["nb"] == math.ceil(r["n"] / 24) == r["bmax"] + 1
    assert b.groupBy("split", "batch_id").count().where("count > 24").count() == 0
    # consecutive: within a split, batch k holds positions 24k .. 24k+23 in row order
    got = {(r["split"], r["row_id"]): r["batch_id"] for r in b.collect()}
    for split in ("train", "val", "test"):
        ids = sorted(i for (s, i) in got if s == split)
        assert [got[(split, i)] for i in ids] == [k // 24 for k in range(len(ids))]
    p = B.pad_batches(b, batch_col=["split", "batch_id"])
    for r in p.collect():
        assert len(r["input_ids"]) == len(r["attention_mask"]) == r["input_len"]
        assert len(r["labels"]) == r["label_len"]
    mx = {(r["split"], r["batch_id"]): (r["mi"], r["ml"]) for r in b.groupBy("split", "batch_id").agg(F.max(F.size("input_ids")).alias("mi"), F.max(F.size("labels")).alias("ml")).collect()}
    assert all((r["input_len"], r["label_len"]) == mx[(r["split"], r["batch_id"])] for r in p.collect())


def test_large_groups_are_not_gathered(spark, monkeypatch):
    """Batches are counted from the start of their group without bringing a group's rows together, be the
    groups few or many."""
    rows = [(i, "train" if i % 10 else None if i % 20 else "val") for i in range(3000)]
    df = spark.createDataFrame(rows, "row_id long, split string")
    got = []
    for few in (100_000, 0):
        monkeypatch.setattr(B, "FEW_STARTS", few)
        b = B.assign_batches(df, 24, ["row_id"], group_cols=["split"])
        plan = b._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(split" not in plan.split("_start")[0]
        assert not [x for x in plan.splitlines() if "Join" in x and "[split" in x]
        got.append(sorted((r.row_id, r.pos, r.batch_id) for r in b.collect()))
    places = {s: {i: k for k, i in enumerate(i for i, t in rows if t == s)} for s in ("train", "val")}
    assert got[0] == got[1] == [(i, places[s][i], places[s][i] // 24) for i, s in rows if s]


def test_token_volume_orders_numbers(spark):
    from qalam.plans import runs

    plan = runs.q_tokens_per_step(spark, "/root/testdata/sf0.001")._jdf.queryExecution().logical().toString()
    assert "source_text" not in plan and "src_tokens" in plan


def test_written_pairs_are_on_disk_once(spark, tmp_path):
    """A sink that reads the corpus once needs no stage beside it; Parquet files are packed well, and the
    shuffle files of a write go with it, while the session's own setting stays."""
    import pyarrow.parquet as pq

    from qalam import session
    from qalam.plans import corpus, io

    d = "/root/testdata/sf0.001/./"
    back = io.QUERIES["read_pairs_parquet"](spark, d)
    key = (spark.sparkContext.applicationId, d)
    assert key not in corpus._STAGES
    files = [f.removeprefix("file://") for f in back.inputFiles()]
    assert {pq.ParquetFile(f).metadata.row_group(0).column(1).compression for f in files} == {"ZSTD"}
    staged = corpus.cleaned_stage(spark, d)
    assert corpus.cleaned_once(spark, d) is staged
    assert sorted(back.collect()) == sorted(staged.select(*back.columns).collect())

    setting = session._DROP_SHUFFLES
    assert spark.conf.get(setting, None) != "true"
    with session.dropping_shuffles(spark):
        assert spark.conf.get(setting) == "true"
    assert spark.conf.get(setting, None) != "true"
