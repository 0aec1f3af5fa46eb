"""Encoding with a trained byte-level BPE model: token ids, decode, vocabulary lookup and audits.

An Arrow task cuts a batch's texts into pieces (special tokens, words with the space before them),
segments each distinct piece once, remembers it, and gathers the ids of all rows, all with numpy
(:mod:`qalam.functions.columnar`); no Python code runs per row or per word. The model (merges bounded by
``vocab_size``) is a broadcast variable.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from qalam.functions.bytelevel import SPECIAL_TOKENS, TAG_AR_ID, TAG_EN_ID, UNK_ID, char_to_byte
from qalam.functions.columnar import Segmenter, char_kinds, cut
from qalam.functions.ranges import ranges
from qalam.operators.bpe import BPEModel

_ENCODERS: dict = {}

IDS = Ty.ArrayType(Ty.IntegerType())
MODEL_COLUMNS = ["input_ids", "attention_mask", "labels"]

#: Bytes of text that are worked on at a time.
SLICE_BYTES = 8 << 20

#: Ids that are decoded at a time.
SLICE_IDS = 2 << 20


def _broadcast(df: DataFrame, model: BPEModel):
    from qalam.session import ship_package

    ship_package(df.sparkSession)
    import uuid

    content = (uuid.uuid4().hex, list(model.tokens), list(model.merges), char_kinds(df.sparkSession))
    return df.sparkSession.sparkContext.broadcast(content)


def _encoder(bc) -> tuple[Segmenter, np.ndarray]:
    """The segmenter of a model, which a Python worker keeps for its next tasks, and the kinds of characters."""
    key, tokens, merges, kinds = bc.value
    enc = _ENCODERS.get(key)
    if enc is None:
        enc = Segmenter(tokens, [tuple(m) for m in merges]), np.frombuffer(kinds, np.uint8)
        _ENCODERS.clear()
        _ENCODERS[key] = enc
    return enc


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _slices(batch: pa.RecordBatch, columns: list[str], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most`` bytes of text, or ids, in ``columns`` (one row at least)."""
    size = {c: pc.list_value_length if pa.types.is_list(batch.schema.field(c).type) else pc.binary_length for c in columns}
    sizes = np.cumsum(sum(pc.fill_null(f(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c, f in size.items()))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _ids(enc: tuple[Segmenter, np.ndarray], texts: pa.Array, limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after the other, and the bounds of each text's, cut to ``limit``."""
    segmenter, kinds = enc
    pieces, bounds = cut(texts.cast(pa.large_string()), kinds)
    if limit is not None and (np.diff(bounds) > limit).any():  # a piece has one id at least
        sizes = np.minimum(np.diff(bounds), limit)
        pieces = pieces.take(pa.array(ranges(bounds[:-1], sizes)))
        bounds = np.concatenate(([0], np.cumsum(sizes)))
    parts = pieces.dictionary_encode()
    starts, lengths, flat = segmenter.distinct(parts.dictionary)
    at = parts.indices.to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(lengths[at])))[bounds]
    out = flat[ranges(starts[at], lengths[at])]
    if limit is None:
        return out, before
    sizes = np.minimum(np.diff(before), limit)
    return out[ranges(before[:-1], sizes)], np.concatenate(([0], np.cumsum(sizes)))


def encode_pairs(
    df: DataFrame,
    model: BPEModel,
    max_len: int | None = 128,
    src_col: str = "source_text",
    tgt_col: str = "target_text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``input_ids``/``attention_mask`` from ``src_col`` and ``labels`` from ``tgt_col``;
    truncated to ``max_len``, no padding, no BOS/EOS."""
    bc = _broadcast(df, model)
    keep = [c for c in (keep if keep is not None else df.columns) if c not in MODEL_COLUMNS]
    schema = Ty.StructType([df.schema[c] for c in keep] + [Ty.StructField(c, IDS) for c in MODEL_COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(bc)
        for batch in (part for whole in batches for part in _slices(whole, ["_src", "_tgt"])):
            (ids, ends), (labels, label_ends) = (_ids(enc, batch.column(c), max_len) for c in ("_src", "_tgt"))
            lists = [(ends, ids), (ends, np.ones(len(ids), np.int32)), (label_ends, labels)]
            out = [pa.ListArray.from_arrays(pa.array(e.astype(np.int32)), pa.array(x)) for e, x in lists]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *out], [*keep, *MODEL_COLUMNS])

    return df.select(*keep, _text(src_col).alias("_src"), _text(tgt_col).alias("_tgt")).mapInArrow(run, schema)


def model_columns(df: DataFrame) -> DataFrame:
    return df.select(*MODEL_COLUMNS)


def token_lengths(df: DataFrame, model: BPEModel, cols: list[str]) -> DataFrame:
    """Untruncated token count and unknown-token count per text column (``<col>_len``,
    ``<col>_unk``)."""
    bc = _broadcast(df, model)
    new = [f"{c}_{what}" for c in cols for what in ("len", "unk")]
    schema = Ty.StructType(list(df.schema.fields) + [Ty.StructField(c, Ty.LongType()) for c in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(bc)
        for batch in (part for whole in batches for part in _slices(whole, texts)):
            out = []
            for c in texts:
                ids, ends = _ids(enc, batch.column(c))
                unknown = np.concatenate(([0], np.cumsum(ids == UNK_ID)))[ends]
                out += [pa.array(np.diff(ends).astype(np.int64)), pa.array(np.diff(unknown).astype(np.int64))]
            kept = [batch.column(f.name) for f in df_fields]
            yield pa.RecordBatch.from_arrays([*kept, *out], [*(f.name for f in df_fields), *new])

    df_fields, texts = list(df.schema.fields), [f"_text{i}" for i in range(len(cols))]
    return df.select("*", *(_text(c).alias(t) for c, t in zip(cols, texts, strict=True))).mapInArrow(run, schema)


def decode_ids(df: DataFrame, model: BPEModel, cols: list[str], skip_special: bool = False, keep: list[str] | None = None) -> DataFrame:
    """ids -> text for each column in ``cols`` (adds ``decoded_<col>``). Negative ids (label padding) and,
    with ``skip_special``, special tokens are left out. Of the other columns, those in ``keep`` are given
    back (default: all)."""
    bc = _broadcast(df, model)
    names = list(keep if keep is not None else df.columns)
    schema = Ty.StructType([df.schema[c] for c in names] + [Ty.StructField(f"decoded_{c}", Ty.StringType()) for c in cols])
    first = len(SPECIAL_TOKENS) if skip_special else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _decoder(bc.value[1], first)
        for batch in (part for whole in batches for part in _slices(whole, cols, SLICE_IDS)):
            out = [decode(batch.column(c)) for c in cols]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *out], schema.names)

    return df.select(*dict.fromkeys([*names, *cols])).mapInArrow(run, schema)


def _decoder(tokens: list[str], first: int) -> Callable[[pa.ListArray], pa.Array]:
    """Rows of ids as texts: the bytes of all tokens are gathered at once, then cut by row."""
    to_byte = char_to_byte()
    raw = [bytes(to_byte[c] for c in t) if all(c in to_byte for c in t) else t.encode() for t in tokens]
    lengths = np.array([len(b) for b in raw], np.int64)
    flat, starts = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(lengths) - lengths

    def decode(lists: pa.ListArray) -> pa.Array:
        offsets = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)
        sizes = np.where(ids >= first, lengths[np.maximum(ids, 0)], 0)
        data = flat[ranges(starts[np.maximum(ids, 0)], sizes)]
        ends = np.concatenate(([0], np.cumsum(sizes)))[offsets - offsets[0]]
        if _whole(data, ends):
            texts = pa.Array.from_buffers(pa.large_string(), len(lists), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            return pc.if_else(lists.is_valid(), texts, None).cast(pa.string())
        data, ends = data.tobytes(), ends.tolist()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]
        return pa.array([t if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist(), strict=True)], pa.string())

    return decode


def _whole(data: np.ndarray, ends: np.ndarray) -> bool:
    """Whether every text is UTF-8 without a replacement: all bytes are, and no text starts inside a character."""
    try:
        str(data.data, "utf-8")
    except UnicodeDecodeError:
        return False
    return bool((data[ends[ends < len(data)]] & 0xC0 != 0x80).all())


def vocab_lookup(tokens: DataFrame, model: BPEModel, token_col: str = "token", strict: bool = True) -> DataFrame:
    """token -> id via a broadcast join; the vocabulary is bounded by the model's size."""
    v = model.vocab_df(tokens.sparkSession).select(F.col("token").alias(token_col), "id")
    out = tokens.join(F.broadcast(v), token_col, "left")
    if strict:
        missing = out.where(F.col("id").isNull()).select(token_col).limit(5).collect()
        if missing:
            raise ValueError(f"tokens missing from vocabulary: {[r[0] for r in missing]}")
    return out


def special_token_audit(spark, model: BPEModel, encoded: DataFrame | None = None) -> DataFrame:
    """Ids of the six special tokens, and whether tagged probes encode to the tag id first.

    With ``encoded`` (rows with ``direction`` and ``input_ids``) every row is checked too: per
    tag, ``tagged_rows`` (rows of that direction) and ``tag_first_rows`` (rows whose first id
    is the tag's id). The per-tag aggregate combines map-side, so two keys cannot skew it."""
    enc = model.encoder()
    probe_ar = enc.encode("<2ar> this is a test")
    probe_en = enc.encode("<2en> english direction probe")
    ok_ar = bool(probe_ar) and probe_ar[0] == TAG_AR_ID
    ok_en = bool(probe_en) and probe_en[0] == TAG_EN_ID
    toks = spark.createDataFrame([(t,) for t in SPECIAL_TOKENS], "token string")
    out = vocab_lookup(toks, model, strict=False)
    out = out.select("token", "id", F.lit(ok_ar).alias("probe_2ar_first"), F.lit(ok_en).alias("probe_2en_first"))
    if encoded is None:
        return out
    from qalam.functions.text import AR_TO_EN, EN_TO_AR

    tag = F.when(F.col("direction") == EN_TO_AR, F.lit(TAG_AR_ID)).when(F.col("direction") == AR_TO_EN, F.lit(TAG_EN_ID))
    per = encoded.select(tag.alias("id"), (F.get("input_ids", 0) == tag).alias("first"))
    counts = per.where(F.col("id").isNotNull()).groupBy("id").agg(
        F.count(F.lit(1)).alias("tagged_rows"), F.sum(F.coalesce(F.col("first"), F.lit(False)).cast("long")).alias("tag_first_rows")
    )
    return out.join(counts, "id", "left").select(
        "token",
        "id",
        "probe_2ar_first",
        "probe_2en_first",
        F.coalesce("tagged_rows", F.lit(0)).cast("long").alias("tagged_rows"),
        F.coalesce("tag_first_rows", F.lit(0)).cast("long").alias("tag_first_rows"),
    )


def tokenizer_audit(df: DataFrame, model: BPEModel, max_len: int = 128, sample_n: int = 20_000, seed: int = 42) -> DataFrame:
    """Sample-based token-length, truncation and unknown-token audit (metric, value)."""
    from qalam.operators.sample import sample_exact

    s = sample_exact(df, sample_n, seed)
    lens = token_lengths(s, model, ["source_text", "target_text"])
    sl, tl = F.col("source_text_len"), F.col("target_text_len")
    aggs = [F.count(F.lit(1)).cast("double").alias("sample_rows"), F.lit(float(len(model.tokens))).alias("trained_vocab_size")]
    for name, c in (("src", "source_text_len"), ("tgt", "target_text_len")):
        for p in (50, 90, 95, 99):
            aggs.append(F.floor(F.percentile(c, p / 100)).cast("double").alias(f"{name}_len_p{p}"))
    aggs += [
        F.avg((sl > max_len).cast("double")).alias("src_trunc_ratio_gt_max_len"),
        F.avg((tl > max_len).cast("double")).alias("tgt_trunc_ratio_gt_max_len"),
        F.avg(((sl > max_len) | (tl > max_len)).cast("double")).alias("either_trunc_ratio_gt_max_len"),
        F.sum("source_text_unk").cast("double").alias("src_unk_tokens"),
        F.sum("target_text_unk").cast("double").alias("tgt_unk_tokens"),
    ]
    wide = lens.agg(*aggs)
    names = [a for a in wide.columns]
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.select(F.expr(f"stack({len(names)}, {stack}) as (metric, value)"))
