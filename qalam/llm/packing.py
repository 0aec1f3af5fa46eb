"""Packing by power-of-two decomposition.

A document's tokens are cut into pieces whose lengths are powers of two: as many of the longest
length as fit, then one for each bit of the rest. Every piece is a sequence of its own, so no
sequence crosses documents and none is padded; sequences of one length form a bucket from which
equal-shaped batches can be drawn.

Tokens are made once, in Arrow tasks, and staged; cutting, checksums and numbering are built-in
functions over the staged table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qalam.llm.tables import id_and_text, shuffle_partitions, stage
from qalam.llm.word_ids import text_slices, trim_memory, with_end, word_encoder

#: Longest sequence; a power of two.
MAX_LENGTH = 4096


def token_bytes(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row: ids with ``end_id``, as little-endian 32-bit numbers."""
    return id_and_text(docs).mapInArrow(_encoder(tokenizer_path, end_id), "doc_id long, n_tokens long, ids binary")


def _encoder(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            for part in text_slices(batch, "text"):
                flat, lengths = with_end(*encoder.encode(part.column("text")), end_id)
                offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32) * 4
                ids = pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lengths), ids], ["doc_id", "n_tokens", "ids"])
        trim_memory()

    return encode


def cut(tokens: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids, ids_crc32``."""
    bits = max_length.bit_length() - 1
    full = f"IF(n_tokens >= {max_length}, transform(sequence(0L, n_tokens DIV {max_length} - 1), i -> struct(i * {max_length} AS start, {max_length}L AS length)), array())"
    # where the piece of bit b starts, the bits above it are done
    rest = (
        f"transform(filter(sequence({bits - 1}, 0, -1), b -> getbit(n_tokens, b) = 1), "
        "b -> struct(n_tokens - n_tokens % shiftleft(2L, b) AS start, shiftleft(1L, b) AS length))"
    )
    pieces = tokens.select("doc_id", "n_tokens", "ids", F.explode(F.expr(f"concat({full}, {rest})")).alias("p"))
    ids = F.expr("substring(ids, CAST(4 * p.start + 1 AS INT), CAST(4 * p.length AS INT))")
    return pieces.select(
        "doc_id",
        F.col("p.start").alias("start"),
        F.col("p.length").alias("length"),
        F.col("n_tokens").alias("doc_tokens"),
        ids.alias("ids"),
        F.crc32(ids).alias("ids_crc32"),
    )


def numbered(pieces: DataFrame) -> DataFrame:
    """``sequence_id`` counts the pieces from 0, bucket by bucket (shortest first).

    Pieces are dealt by (length, hash); each such group is numbered in its own task from the count of
    the groups before it, a table of at most 13 rows per partition."""
    slots = shuffle_partitions(pieces.sparkSession)
    dealt = pieces.withColumn("slot", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slots)))
    sizes = dealt.groupBy("length", "slot").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("length", "slot").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("length", "slot").orderBy("doc_id", "start", "ids_crc32"))
    ranked = dealt.withColumn("rank", rank)
    return ranked.join(F.broadcast(firsts), ["length", "slot"]).withColumn("sequence_id", F.col("first") + F.col("rank") - 1)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, max_length: int = MAX_LENGTH) -> DataFrame:
    """``doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset`` for every piece.

    Each document has its end id at least, so a null or empty text is one piece of length 1. A piece
    fills its sequence (``offset`` 0). Repeated rows give pieces of their own, null ids stay, an empty
    table gives an empty result, other columns are ignored."""
    if max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    tokens = stage(token_bytes(docs, tokenizer_path, end_id), "tokens")
    return numbered(cut(tokens, max_length)).select(
        "doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset")
    )
