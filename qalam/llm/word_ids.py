"""Token ids of whole texts by a word-level BPE file, for use inside Arrow tasks.

The pre-tokeniser of such a file never joins what white space separates, nor a letter with the
punctuation after it, so a text's ids are those of the parts between in turn. A task hands each
distinct part to the tokenizers library once and gathers the ids of all texts of a batch with numpy.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts that a Python worker remembers between batches; beyond them it forgets the older half.
MAX_CACHED_WORDS = 200_000

#: Bytes of text that are worked on at a time.
SLICE_BYTES = 4 << 20

#: A letter and the mark after it, which the pre-tokeniser always separates. Marks that contractions
#: or special tokens are made of are left out, and the letter that is not one in lower case (U+0130).
LETTER_MARK = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}])([.,;:!?%&$#*])"


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each (one row at least)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def trim_memory() -> None:
    """Give freed memory back to the system. Spark keeps Python workers for later tasks, and what one
    holds back another task of the executor can't have."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + length]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total, dtype=np.int64) + np.repeat(starts - ends + lengths, lengths)]


#: Parts of letters alone, none of which composes with another or has more than one lower-case letter.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def lowers_whole_words(path: str) -> bool:
    """True for a file that does nothing to a word of ``LETTERS`` before its merges but to lower-case it
    and to write its bytes as symbols: its model can then be asked directly."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    normal, split = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    kinds = [x["type"] for x in normal.get("normalizers", [])], [x["type"] for x in split.get("pretokenizers", [])]
    if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
        return False
    replaced, (cut, level) = normal["normalizers"][1], split["pretokenizers"]
    return (
        replaced["pattern"] == {"Regex": r"\s+"}
        and cut["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
        and (cut["behavior"], cut["invert"]) == ("Removed", True)
        and (level["add_prefix_space"], level["use_regex"]) == (False, False)
        and not any(LETTERS.fullmatch(t["content"]) for t in spec["added_tokens"])
    )


def byte_symbols() -> dict[int, str]:
    """The symbol of every byte: itself if it is printable, else the next character from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model if lowers_whole_words(path) else None
        self.symbols = byte_symbols()
        self.known: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        lower = word.lower()
        symbols = lower if lower.isascii() else lower.encode().decode("latin-1").translate(self.symbols)
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def _ids(self, words: list[str]) -> list[bytes]:
        if len(self.known) > MAX_CACHED_WORDS:
            self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
        rest = []
        for word in words:
            if word not in self.known:
                if self.model is not None and LETTERS.fullmatch(word):
                    self.known[word] = self._word(word)
                else:
                    rest.append(word)
        for word, got in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.known[word] = array("I", got.ids).tobytes()
        return [self.known[w] for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` (without nulls) one after the other, and the number of each text."""
        texts = texts.cast(pa.large_string())
        spaced = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), LETTER_MARK, r"\1 \2")
        parts = pc.split_pattern(spaced, " ")
        words = parts.flatten().dictionary_encode()
        ids = self._ids(words.dictionary.to_pylist())
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        at = words.indices.to_numpy(zero_copy_only=False)
        of_word = lengths[at]
        out = ragged(flat, (np.cumsum(lengths) - lengths)[at], of_word)
        bounds = np.concatenate(([0], np.cumsum(of_word)))
        offsets = parts.offsets.to_numpy().astype(np.int64)
        return out, np.diff(bounds[offsets - offsets[0]])


@cache
def word_encoder(path: str) -> WordEncoder:
    """The encoder of a file; a Python worker keeps it for its next tasks."""
    return WordEncoder(path)


def with_end(flat: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with the id ``end`` after each."""
    return np.insert(flat, np.cumsum(lengths), np.uint32(end)).astype("<u4", copy=False), lengths + 1
