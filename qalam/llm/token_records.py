"""Token ids in length-delimited binary records, with an offset index for reads in any order.

A shard is a file of records, each framed as::

    uint64 length | uint32 masked checksum of the length | payload | uint32 masked checksum of the payload

The payload is one document: a byte that says whether it has an id, the id as int64, a byte with the
width of its token ids (2 or 4), then the ids as little-endian unsigned numbers of that width, the
smaller one where the vocabulary allows it. Checksums are CRC-32, rotated right by 15 bits plus a constant, so that
a checksum stored next to what it covers is not itself a valid checksum.

Rows are range-partitioned by document id; each task sorts its range, encodes it and writes one
shard under a name of its attempt, then renames it, so a lost or repeated task leaves one whole file.
The index, a Parquet table beside the shards, has one row per record. The folder is one that all
executors share and that ``pyarrow.fs`` can open.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qalam.llm.tables import id_and_text, shuffle_partitions
from qalam.llm.word_ids import text_slices, trim_memory, with_end, word_encoder

#: Fixed value of the checksum mask.
MASK_DELTA = 0xA282EAD8

#: struct formats of a record's length, of its checksums and of the start of its payload.
LENGTH, CHECK, HEADER = "<Q", "<I", "<BqB"
HEADER_BYTES = struct.calcsize(HEADER)

INDEX_SCHEMA = "doc_id long, shard int, file string, offset long, size long, first long, n_tokens long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(LENGTH, len(payload))
    return b"".join((length, struct.pack(CHECK, masked(length)), payload, struct.pack(CHECK, masked(payload))))


def unframe(data: bytes) -> bytes:
    """The payload of one record; an error if its lengths or checksums don't hold."""
    after_length, head = struct.calcsize(LENGTH), struct.calcsize(LENGTH) + struct.calcsize(CHECK)
    length = data[:after_length]
    (size,) = struct.unpack(LENGTH, length)
    payload = data[head : head + size]
    if struct.unpack_from(CHECK, data, after_length)[0] != masked(length) or len(data) != head + size + struct.calcsize(CHECK):
        raise ValueError("record with a damaged length")
    if struct.unpack_from(CHECK, data, head + size)[0] != masked(payload):
        raise ValueError("record with a damaged payload")
    return payload


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system and the path in it; Hadoop's spellings of local and S3 folders are accepted."""
    uri = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri))
    return pafs.FileSystem.from_uri(uri)


def _writer(path: str, tokenizer_path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard, name = task.partitionId(), f"shard-{task.partitionId():06d}.rec"
        fs, folder = open_folder(path)
        draft = f"{folder}/.{name}.{task.taskAttemptId()}"
        encoder, offset, first, out = word_encoder(tokenizer_path), 0, 0, None
        width = 2 if max(end_id, encoder.tokenizer.get_vocab_size() - 1) < 1 << 16 else 4
        for batch in batches:
            out = out or fs.open_output_stream(draft)
            for part in text_slices(batch, "text"):
                flat, lengths = with_end(*encoder.encode(part.column("text")), end_id)
                ids, at, rows, frames = flat.astype(f"<u{width}").tobytes(), 0, [], []
                for doc_id, n in zip(part.column("doc_id").to_pylist(), lengths.tolist(), strict=True):
                    record = frame(struct.pack(HEADER, doc_id is not None, doc_id or 0, width) + ids[at : at + width * n])
                    frames.append(record)
                    rows.append((doc_id, shard, name, offset, len(record), first, n))
                    offset, first, at = offset + len(record), first + n, at + width * n
                out.write(b"".join(frames))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), INDEX_TYPES, strict=True)], names=INDEX_NAMES
                )
        if out:
            out.close()
            fs.move(draft, f"{folder}/{name}")
        trim_memory()

    return write


INDEX_NAMES = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]
INDEX_TYPES = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[x.split()[1]] for x in INDEX_SCHEMA.split(", ")]


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, shards: int | None = None) -> None:
    """Write ``docs`` as shards in ascending ``doc_id`` order (nulls first) and their index to ``path``.

    Rows that repeat an id follow each other by the hash of their texts; each is a record."""
    spark = docs.sparkSession
    fs, folder = open_folder(path)
    fs.create_dir(folder, recursive=True)
    rows = id_and_text(docs).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(shards or shuffle_partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    index = ordered.select("doc_id", "text").mapInArrow(_writer(path, tokenizer_path, end_id), INDEX_SCHEMA)
    index.write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index, with ``start``: the number of token ids before the record in the whole data set."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")
    # one row per shard, as many as the writing tasks
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    firsts = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    return index.join(F.broadcast(firsts), "shard").withColumn("start", F.col("base") + F.col("first"))


def _reader(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_folder(path)
        name, file = None, None
        for whole in batches:
            for batch in [whole.slice(i, 1000) for i in range(0, whole.num_rows, 1000)]:
                doc_ids, ids = [], []
                for wanted, offset, size in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "size")), strict=True):
                    if wanted != name:
                        name, file = wanted, fs.open_input_file(f"{folder}/{wanted}")
                    payload = unframe(file.read_at(size, offset))
                    has_id, doc_id, width = struct.unpack_from(HEADER, payload)
                    doc_ids.append(doc_id if has_id else None)
                    ids.append(np.frombuffer(payload, dtype=f"<u{width}", offset=HEADER_BYTES).astype("<u4").tobytes())
                lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), batch.column("start"), pa.array(lengths), pa.array(ids, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return read


def read_records(index: DataFrame, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of the records that the rows of ``index`` name, in their order.

    Any part of the index can be given, shuffled too; only those records are read, and each is checked."""
    return index.select("file", "offset", "size", "start").mapInArrow(_reader(path), "doc_id long, start long, n_tokens long, ids binary")


def token_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, shards: int | None = None) -> DataFrame:
    """Write ``docs`` to ``path`` and read every record back.

    A null or empty text is a record with the end id alone. Null ids stay, repeated rows are records of
    their own, an empty table gives no record, other columns are ignored."""
    write_records(docs, path, tokenizer_path, end_id, shards)
    return read_records(read_index(docs.sparkSession, path), path)
