"""Registered tokenizer queries: word counts -> BPE merges -> ids -> audits -> padded batches.

Ids have no SQL twin, but decoding every row must give its text back, and each row must start with
its tag's id: those two queries have oracles. The others' exactness against the tokenizer library is
covered by tests/test_bpe.py.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from qalam.operators import batch as B
from qalam.operators import bpe as BPE
from qalam.operators import encode as EN
from qalam.operators import sample as S
from qalam.operators.runlog import GRAD_ACCUM
from qalam.plans.corpus import SEED, bidir

VOCAB = 32_000
MAX_LEN = 128
#: Models of this Spark application, as the queries on one model would each train it again.
_MODELS: dict[tuple[str, str, int], BPE.BPEModel] = {}


def train_words(spark, d):
    tr = bidir(spark, d).where(F.col("split") == "train")
    return BPE.pretoken_counts(tr, ["source_text", "target_text"])


def model(spark, d, vocab_size: int = VOCAB) -> BPE.BPEModel:
    key = (spark.sparkContext.applicationId, d, vocab_size)
    if key not in _MODELS:
        _MODELS[key] = BPE.train_bpe(train_words(spark, d), vocab_size=vocab_size)
    return _MODELS[key]


def encoded(spark, d):
    """Every split of the bidirectional table, as the reference tokenises train, val and test."""
    return EN.encode_pairs(bidir(spark, d), model(spark, d), MAX_LEN, keep=["row_id", "direction", "split"])


def batched(spark, d, split: str | None = None):
    """Consecutive batches of 24 within each split in the seeded draw order, then token ids.

    Batch positions depend only on the draw key, so they are assigned on the text rows and the
    Python encoder runs once, after the range-partitioned index (whose sampling pass would
    otherwise evaluate the encoder a second time)."""
    rows = B.assign_batches(bidir(spark, d), 24, [S.draw_key(SEED), F.col("row_id")], group_cols=["split"])
    if split:
        rows = rows.where(F.col("split") == split)
    return EN.encode_pairs(rows, model(spark, d), MAX_LEN, keep=["row_id", "direction", "split", "batch_id"])


def q_pretoken_counts(spark, d):
    return train_words(spark, d)


def q_train_bpe(spark, d):
    return model(spark, d).merges_df(spark)


def q_vocab_lookup(spark, d):
    words = BPE.pretoken_counts(bidir(spark, d), ["source_text", "target_text"]).select(F.col("word").alias("token"))
    return EN.vocab_lookup(words, model(spark, d), strict=False)


def q_encode_pairs(spark, d):
    return encoded(spark, d)


def q_model_columns(spark, d):
    return EN.model_columns(encoded(spark, d))


def q_special_token_audit(spark, d):
    first = EN.encode_pairs(bidir(spark, d), model(spark, d), 1, keep=["direction"])
    return EN.special_token_audit(spark, model(spark, d), first)


def q_decode_roundtrip(spark, d):
    """Every row, encoded without a length limit and decoded again: byte-level ids lose nothing."""
    ids = EN.encode_pairs(bidir(spark, d), model(spark, d), None, keep=["row_id", "direction", "split"])
    # the ids and the mask need not come back with the texts
    return EN.decode_ids(ids, model(spark, d), ["input_ids", "labels"], skip_special=False, keep=["row_id", "direction", "split"])


def q_tokenizer_audit(spark, d):
    return EN.tokenizer_audit(bidir(spark, d), model(spark, d), MAX_LEN, 20_000, SEED)


def q_pad_batches(spark, d):
    padded = B.pad_batches(batched(spark, d), batch_col=["split", "batch_id"])
    return padded.select("row_id", "split", "batch_id", "input_len", "label_len", "input_ids", "attention_mask", "labels")


def q_tokens_per_step_ids(spark, d):
    """Token volume per optimizer step of the training loader (train split batches)."""
    padded = B.pad_batches(batched(spark, d, "train"))
    per_row = padded.select("batch_id", *[v.alias(k) for k, v in B.token_counts().items()])
    return B.tokens_per_step(per_row, grad_accum=GRAD_ACCUM, max_steps=200)


QUERIES = {
    "pretoken_counts": q_pretoken_counts,
    "train_bpe": q_train_bpe,
    "vocab_lookup": q_vocab_lookup,
    "encode_pairs": q_encode_pairs,
    "model_columns": q_model_columns,
    "special_token_audit": q_special_token_audit,
    "decode_roundtrip": q_decode_roundtrip,
    "tokenizer_audit": q_tokenizer_audit,
    "pad_batches": q_pad_batches,
    "tokens_per_step_ids": q_tokens_per_step_ids,
}
