"""SentencePiece codec, packing and token records against the libraries themselves."""

import hashlib
import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb
from tokenizers import Tokenizer

from qalam.llm import packing as PK
from qalam.llm import piece_codec as PC
from qalam.llm import token_records as TR
from qalam.llm.word_ids import WordEncoder, ragged, text_slices
from qalam.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ALPHABET = "ab zAÉé ,.;:!?%&$#*|<>'’\n\t\r\x0b\x0c\x1c\x85  　́̈ﬁİΣς1२\U0001f600▁"


def odd_texts(n=400):
    rng = random.Random(5)
    out = ["", " ", "\n", "▁", "it's we'll I'M don't.", "<|endoftext|>x <|startoftext|>, a<|endoftext|>.", "</s><s><0x0A>", "é, é,"]
    return out + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(documents, awkward):
    return documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


# word ids


def test_word_ids_equal_the_library():
    texts, library = odd_texts(), Tokenizer.from_file(WORDS)
    flat, lengths = WordEncoder(WORDS).encode(pa.array(texts))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert lengths.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


def test_word_ids_of_a_sliced_array():
    texts = odd_texts(20)
    part = pa.array(texts).slice(3, 9)
    flat, lengths = WordEncoder(WORDS).encode(part)
    whole, n = WordEncoder(WORDS).encode(pa.array(texts[3:12]))
    assert flat.tolist() == whole.tolist() and lengths.tolist() == n.tolist()


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 0, 100, 1, 1, 30)])], ["text"])
    parts = [p.column("text").to_pylist() for p in text_slices(batch, "text", 10)]
    assert [t for p in parts for t in p] == batch.column("text").to_pylist()
    assert all(len(p) == 1 or sum(map(len, p)) <= 10 for p in parts)


def test_ragged():
    flat = np.arange(10)
    assert ragged(flat, np.array([7, 0, 3]), np.array([2, 0, 3])).tolist() == [7, 8, 3, 4, 5]


# codec


def test_codec_equals_the_library_and_spans_tile_the_text():
    texts, library, codec = odd_texts(), sentencepiece.SentencePieceProcessor(model_file=PIECES), PC.PieceCodec(PIECES)
    ids, begins, ends, lengths = codec.encode(texts)
    at = 0
    for text, n in zip(texts, lengths, strict=True):
        assert ids[at : at + n].tolist() == library.encode(text, add_eos=True)
        spans = list(zip(begins[at : at + n].tolist(), ends[at : at + n].tolist(), strict=True))
        assert spans[0][0] == 0 and spans[-1][1] == len(text.encode())
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
        pieces = library.encode(text, return_type="proto").pieces if text else []
        for p, span in zip(pieces, spans, strict=False):
            if not p.piece.startswith("<0x"):
                assert span == (p.begin, p.end)
        at += n


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf", "nfkc"])
@pytest.mark.parametrize("tidy", [True, False])
def test_normaliser_walks_the_compiled_map(rule, tidy):
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=tidy
    )
    proto = pb.ModelProto()
    proto.ParseFromString(library.serialized_model_proto())
    mine, rng = PC.Normaliser(proto.normalizer_spec), random.Random(1)
    pool = "abcÀé ﬁ①Ａ　\t\n­​ｶﾞ ㌔ガéⅧ½ ▁  한글\U0001f600İß"
    for _ in range(1500):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 15)))
        want, align = library.normalize(text.encode(), with_offsets=True)
        got, at = mine.normalise(text.encode())
        assert got == (want.encode() if isinstance(want, str) else want)
        if got:
            assert at.tolist() == list(align)


def test_codec_over_documents(docs):
    from qalam.llm.queries import op4_piece_codec  # the digests of the query, over the same rows

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoded = PC.encode_pieces(docs, PIECES)
    got = Counter((r.doc_id, tuple(r.ids), r.ends[-1]) for r in encoded.collect())
    assert got == Counter((i, tuple(library.encode(t, add_eos=True)), len(t.encode())) for i, t in rows_of(docs))
    decoded = Counter((r.doc_id, r.text) for r in PC.decode_pieces(encoded, PIECES).collect())
    assert decoded == Counter((i, library.decode(library.encode(t, add_eos=True))) for i, t in rows_of(docs))
    spark = docs.sparkSession
    digests = {r.doc_id: r for r in op4_piece_codec(spark, "/root/testdata/sf0.001").collect()}
    for doc_id, text in rows_of(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")):
        ids = library.encode(text, add_eos=True)
        row = digests[doc_id]
        assert (row.n_tokens, row.n_bytes) == (len(ids), len(text.encode()))
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_codec_of_empty_tables(empty, awkward):
    assert PC.encode_pieces(empty, PIECES).collect() == []
    assert PC.decode_pieces(PC.encode_pieces(empty, PIECES), PIECES).collect() == []
    assert PC.encode_pieces(awkward, PIECES).columns == ["doc_id", "ids", "begins", "ends"]


# packing


def ids_by_doc(docs, end):
    library = Tokenizer.from_file(WORDS)
    rows = rows_of(docs)
    encoded = library.encode_batch([t for _, t in rows], add_special_tokens=False)
    return Counter((i, tuple([*e.ids, end])) for (i, _), e in zip(rows, encoded, strict=True))


def test_packing(docs):
    pieces = PK.pack(docs, WORDS, end_id=2, max_length=64).collect()
    assert sorted(p.sequence_id for p in pieces) == list(range(len(pieces)))
    by_length = sorted(pieces, key=lambda p: p.sequence_id)
    assert [p.length for p in by_length] == sorted(p.length for p in pieces)  # buckets of one length
    for p in pieces:
        assert p.length & (p.length - 1) == 0 and p.length <= 64 and p.offset == 0
        assert p.ids_crc32 == zlib.crc32(p.ids) and len(p.ids) == 4 * p.length
    # pieces of a document, put together again, are its ids; lengths are the binary digits of its length
    parts = {}
    for p in pieces:
        parts.setdefault((p.doc_id, p.doc_tokens, p.start), []).append(p)
    want = ids_by_doc(docs, 2)
    starts = Counter((p.doc_id, p.doc_tokens, p.start, bytes(p.ids)) for p in pieces)
    expected = Counter()
    for (doc_id, ids), n in want.items():
        at = 0
        while at < len(ids):
            left = len(ids) - at
            size = 64 if left >= 64 else 1 << (left.bit_length() - 1)
            expected[doc_id, len(ids), at, np.array(ids[at : at + size], dtype="<u4").tobytes()] += n
            at += size
    assert starts == expected


def test_packing_of_an_empty_table(empty):
    assert PK.pack(empty, WORDS, end_id=2).collect() == []
    with pytest.raises(ValueError):
        PK.pack(empty, WORDS, end_id=2, max_length=100)


# token records


def test_token_records(docs, spark):
    path = scratch_path(spark, "records")
    got = TR.token_records(docs, path, WORDS, end_id=1, shards=5).orderBy("start").collect()
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == ids_by_doc(docs, 1)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    # any part of the index, in any order
    some = TR.read_index(spark, path).filter("doc_id % 7 = 3").orderBy(F.rand(1))
    part = Counter((r.doc_id, r.start, bytes(r.ids)) for r in TR.read_records(some, path).collect())
    assert part == Counter((r.doc_id, r.start, bytes(r.ids)) for r in got if r.doc_id is not None and r.doc_id % 7 == 3)


def test_shards_are_plain_frames(docs, spark):
    """The files can be read from front to back without the index."""
    path = scratch_path(spark, "records")
    TR.write_records(docs, path, WORDS, end_id=1, shards=3)
    fs, folder = TR.open_folder(path)
    n = 0
    for shard in sorted({r.file for r in TR.read_index(spark, path).collect()}):
        data = fs.open_input_file(f"{folder}/{shard}").read()
        while data:
            (size,) = struct.unpack_from("<Q", data)
            TR.unframe(data[: size + 16])
            data, n = data[size + 16 :], n + 1
    assert n == docs.count()


def test_damaged_records_are_refused():
    record = TR.frame(b"some payload")
    assert TR.unframe(record) == b"some payload"
    for i in range(len(record)):
        damaged = bytearray(record)
        damaged[i] ^= 1
        with pytest.raises((ValueError, struct.error)):
            TR.unframe(bytes(damaged))


def test_token_records_of_an_empty_table(empty, spark):
    assert TR.token_records(empty, scratch_path(spark, "records"), WORDS, end_id=1).collect() == []


def test_folders():
    assert TR.open_folder("file:/tmp/x")[1] == TR.open_folder("/tmp/x")[1] == "/tmp/x"
