"""Offset-preserving SentencePiece encoding and decoding.

``Normaliser`` does what the model's normaliser does, and records where each normalised byte comes
from: at every position the longest key of the compiled character map (a double-array trie in the
model file) is replaced by its value, other characters stay, spaces become the model's space mark.

The normalised text is then cut before each run of space marks and around line ends. No piece of the
vocabulary goes on past such a cut, so each stretch is encoded on its own, once per distinct stretch,
by the library with the model's vocabulary and a normaliser that changes nothing. Every piece's span in the
normalised text is projected to bytes of the original text through the alignment.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from qalam.llm.tables import id_and_text
from qalam.llm.word_ids import ragged, text_slices, trim_memory

#: Fixed value: the character that stands for a space in pieces.
MARK = "▁"
MARK_BYTES = MARK.encode()

#: Distinct stretches that a task remembers; beyond them it starts anew.
MAX_CACHED = 300_000

STRETCH = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n+")


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 keys whose values are offsets of strings."""

    def __init__(self, blob: bytes):
        self.units: np.ndarray = np.zeros(0, dtype="<u4")
        self.values = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4)
            self.values = blob[4 + size :]
        self.cells: list[int] = self.units.tolist()

    def longest(self, text: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest key at ``at`` and its value; length 0 where there is none."""
        if not self.cells:
            return 0, b""
        found, value, node, unit = 0, 0, 0, self.cells[0]
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for k in range(at, len(text)):
            node ^= text[k]
            unit = self.cells[node]
            if unit & 0x800000FF != text[k]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                found, value = k + 1 - at, self.cells[node] & 0x7FFFFFFF
        return found, self.values[value : self.values.index(b"\0", value)] if found else b""


class Normaliser:
    def __init__(self, spec: object):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.tidy, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def steps(self, text: bytes) -> Iterator[tuple[int, int, bytes]]:
        """(start, end, replacement) of the map's replacements in order; single characters else."""
        at = 0
        while at < len(text):
            size, value = self.map.longest(text, at)
            if not size:
                first = text[at]
                size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                value = text[at : at + size]
            yield at, at + size, value
            at += size

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the original byte it starts at."""
        if not self.map.cells and not self.tidy:
            return self._plain(text)
        space = MARK_BYTES if self.escape else b" "
        steps = list(self.steps(text))
        if self.tidy:
            while steps and steps[0][2].strip(b" ") == b"":
                steps.pop(0)
        if not steps:
            return b"", np.array([len(text) if text else 0])
        out, align = bytearray(), []

        def put(piece: bytes, start: int) -> None:
            out.extend(piece)
            align.extend([start] * len(piece))

        if self.dummy:
            put(space, steps[0][0])
        after_space, end = self.tidy, steps[0][0]
        for start, stop, value in steps:
            if after_space:
                value = value.lstrip(b" ")
            if value:
                put_from = 0
                for i, byte in enumerate(value):
                    if byte == 0x20:
                        put(value[put_from:i], start)
                        put(space, start)
                        put_from = i + 1
                put(value[put_from:], start)
                after_space = self.tidy and value.endswith(b" ")
            end = stop
        if self.tidy:
            while out.endswith(space):
                end = align[len(out) - len(space)]
                del out[len(out) - len(space) :], align[len(out) :]
        align.append(end)
        return bytes(out), np.array(align)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The same without a map and without tidying: only spaces change their length."""
        if not text:
            return b"", np.zeros(1, dtype=np.int64)
        space = MARK_BYTES if self.escape else b" "
        widths = np.where(np.frombuffer(text, dtype=np.uint8) == 0x20, len(space), 1)
        align = np.repeat(np.arange(len(text)), widths)
        lead = len(space) if self.dummy else 0
        return space[:lead] + text.replace(b" ", space), np.concatenate((np.zeros(lead, dtype=np.int64), align, [len(text)]))


class PieceCodec:
    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(model_path, "rb") as f:
            proto.ParseFromString(f.read())
        if any(MARK in p.piece.lstrip(MARK) or "\n" in p.piece for p in proto.pieces):
            raise ValueError("pieces that go on past a space or a line end are not supported")
        if not proto.trainer_spec.byte_fallback:
            raise ValueError("a model without byte pieces has no pieces for unknown characters")
        byte = pb.ModelProto.SentencePiece.BYTE
        self.piece_bytes = np.array([1 if p.type == byte else len(p.piece.encode()) for p in proto.pieces])
        self.normaliser = Normaliser(proto.normalizer_spec)
        self.decoder = sentencepiece.SentencePieceProcessor(model_file=model_path)
        proto.normalizer_spec.precompiled_charsmap = b""
        proto.normalizer_spec.add_dummy_prefix = proto.normalizer_spec.remove_extra_whitespaces = False
        self.encoder = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.end_id = self.decoder.eos_id()
        self._forget()

    def _forget(self) -> None:
        """Start with the end id as the only stretch, number 0."""
        self.known: dict[str, int] = {}
        self.ids, self.counts = array("i", [self.end_id]), array("q", [1])

    def _learn(self, stretches: list[str]) -> None:
        """Number new stretches and keep their ids."""
        for stretch, ids in zip(stretches, self.encoder.encode(stretches, num_threads=1), strict=True):
            self.known[stretch] = len(self.counts)
            self.ids.extend(ids)
            self.counts.append(len(ids))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids of ``texts`` with their first and last (exclusive) original byte, and the number of
        ids of each text. An id that stands for a single byte covers that byte, the end id nothing."""
        if len(self.counts) > MAX_CACHED:
            self._forget()
        normal = [self.normaliser.normalise(t.encode()) for t in texts]
        stretches = [STRETCH.findall(n.decode()) for n, _ in normal]
        known = self.known
        self._learn(list({s for row in stretches for s in row if s not in known}))
        at = np.array([i for row in stretches for i in (*map(known.__getitem__, row), 0)], dtype=np.int64)
        counts = np.array(self.counts)
        of_stretch = counts[at]
        ids = ragged(np.array(self.ids), (np.cumsum(counts) - counts)[at], of_stretch)
        widths = np.where(ids == self.end_id, 0, self.piece_bytes[ids])
        rows = np.array([len(r) + 1 for r in stretches], dtype=np.int64)
        lengths = np.add.reduceat(of_stretch, np.cumsum(rows) - rows) if len(rows) else rows
        # positions in the normalised texts, laid end to end with one more place after each text
        sizes = np.array([len(n) + 1 for n, _ in normal])
        base = np.repeat(np.cumsum(sizes) - sizes, lengths)
        covered = np.cumsum(widths)
        before = np.repeat(np.concatenate(([0], covered))[np.cumsum(lengths) - lengths], lengths)
        align = np.concatenate([a for _, a in normal]) if normal else np.zeros(0, dtype=np.int64)
        stop = base + covered - before
        return ids, align[stop - widths].astype(np.int32), align[stop].astype(np.int32), lengths


SCHEMA = "doc_id long, ids array<int>, begins array<int>, ends array<int>"


def _encoder(model_path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model_path)
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                *columns, lengths = codec.encode(part.column("text").to_pylist())
                offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in columns]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists], ["doc_id", "ids", "begins", "ends"])
        del codec
        trim_memory()

    return encode


def encode_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids, begins, ends`` of every row: the ids of its whole text and the end id, with the
    span of each in bytes of the text.

    A null or empty text has the end id alone. Repeated rows come back alike, null ids stay, an empty
    table gives an empty result, other columns are ignored."""
    return id_and_text(docs).mapInArrow(_encoder(model_path), SCHEMA)


def _decoder(model_path: str, keep: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [library.decode(ids) if ids else "" for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, "text"])

    return decode


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """The rows of ``encoded`` with ``text``, the library's decoding of ``ids``, in place of ``ids``.

    Null or empty ids decode to an empty text."""
    keep = [f for f in encoded.schema.fields if f.name not in ("ids", "text")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    names = [f.name for f in keep]
    return encoded.select(*names, "ids").mapInArrow(_decoder(model_path, names), f"{schema}, text string")
