"""Word shingles of whole texts as numpy arrays, and weighted sets of them, for use in Arrow tasks.

Words are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A text
with fewer words than a shingle has one shingle of all its words; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from qalam.llm.word_ids import text_slices

SIZE = 5

#: Bits of a shingle's hash; the bits above number the text in its slice.
KEY_BITS = 52
SLICE_ROWS = 1 << (64 - KEY_BITS - 1)
SLICE_BYTES = 2 << 20

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint64) + np.uint64(1)
_IS_WORD = (_BYTES >= 128) | np.isin(_BYTES, np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64, remembered."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        got[0] = 1
        _powers[base] = got = np.cumprod(got)
    return got[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of all texts in order, and the number of words of each text."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(bounds[-1] - bounds[0])
    if not size:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    raw = np.frombuffer(data, dtype=np.uint8, count=size, offset=int(bounds[0]))
    at = bounds - bounds[0]
    word = _IS_WORD[raw]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    # a text's first and last byte end words, whatever stands next to them
    edges = at[:-1][at[1:] > at[:-1]]
    first[edges] = word[edges]
    edges = at[1:][at[1:] > at[:-1]] - 1
    last[edges] = word[edges]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LOWER[raw] * powers(_BASE, size))))
    hashes = mixed((sums[ends] - sums[starts]) * powers(_INVERSE, size)[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(starts, at))


def shingles(texts: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count), ordered by text and shingle."""
    words, n = word_hashes(texts)
    factors = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    text = np.repeat(np.arange(len(texts), dtype=np.uint64), n)
    parts_text, parts = [], []
    if len(words) >= size:
        whole = text[size - 1 :] == text[: len(text) - size + 1]
        total = words[: len(words) - size + 1] * factors[0]
        for j in range(1, size):
            total = total + words[j : len(words) - size + 1 + j] * factors[j]
        parts_text.append(text[: len(whole)][whole])
        parts.append(mixed(total[whole]))
    few = (n > 0) & (n < size)
    if few.any():
        starts = np.cumsum(n) - n
        inside = np.repeat(few, n)
        place = (np.arange(len(words)) - np.repeat(starts, n))[inside]
        terms = words[inside] * factors[place]
        sums = np.add.reduceat(terms, np.cumsum(n[few]) - n[few])
        parts_text.append(np.flatnonzero(few).astype(np.uint64))
        parts.append(mixed(sums + n[few].astype(np.uint64)))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = np.concatenate(parts_text) << np.uint64(KEY_BITS) | np.concatenate(parts) >> np.uint64(64 - KEY_BITS)
    keys, counts = np.unique(keys, return_counts=True)
    return (keys >> np.uint64(KEY_BITS)).astype(np.int64), keys & np.uint64((1 << KEY_BITS) - 1), counts


def shingle_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts can be numbered beside a shingle's hash."""
    for part in text_slices(batch, "text", SLICE_BYTES):
        for i in range(0, part.num_rows, SLICE_ROWS):
            yield part.slice(i, SLICE_ROWS)
