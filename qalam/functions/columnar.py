"""Byte-level pre-tokenisation and BPE segmentation of whole Arrow columns with numpy.

No Python code runs per character, word or row. Texts are cut by what two neighbouring characters are,
which the pre-tokenisation pattern allows; distinct words are merged all at once, each word's best pair
in every round.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from qalam.functions.bytelevel import SPECIAL_TOKENS, UNK_ID, byte_to_char
from qalam.functions.ranges import ranges

#: What a character is to the pre-tokeniser. Words are runs of one of the first three.
OTHER, LETTER, NUMBER, SPACE, SPECIAL = range(5)

#: The pattern's contractions, as what may stand after an apostrophe.
_AFTER_APOSTROPHE = ("s", "t", "re", "ve", "m", "ll", "d")

#: Distinct words that a Python worker remembers between batches.
MAX_CACHED_WORDS = 400_000

#: The rank of a pair that is no merge.
_NONE = np.iinfo(np.int32).max


@lru_cache(maxsize=1)
def _kinds(_application: str, spark: SparkSession) -> bytes:
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    kinds = np.zeros(0x110000, np.uint8)
    pattern = spark.sparkContext._jvm.java.util.regex.Pattern
    for kind, others in ((LETTER, r"\P{L}"), (NUMBER, r"\P{N}"), (SPACE, r"\S")):
        found = pattern.compile(f"(?U){others}++").matcher(text).replaceAll("")
        kinds[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return kinds.tobytes()


def char_kinds(spark: SparkSession) -> bytes:
    """The kind of every code point, as the JVM's regular expressions see it (asked on the driver, once in an
    application): words are cut here as :func:`qalam.operators.bpe.pretoken_counts` cuts them."""
    return _kinds(spark.sparkContext.applicationId, spark)


def _is_at(points: np.ndarray, at: np.ndarray, text: str) -> np.ndarray:
    """Whether ``text`` stands at each place of ``points`` (which has a margin)."""
    same = np.ones(len(at), bool)
    for i, c in enumerate(text):
        same &= points[at + i] == ord(c)
    return same


def cut(texts: pa.LargeStringArray, kinds: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The special tokens and words of all texts (without nulls) in a row, and the bounds of each text's.

    Every character belongs to one piece, so what is looked for is where pieces start. A run of letters,
    numbers or others starts one, at the space before it if there is one; so does a run of white space, and
    its last character before a word. An apostrophe that starts a piece takes the end of a contraction."""
    _valid, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or ends[0] == ends[-1]:
        return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
    data = data.slice(ends[0], ends[-1] - ends[0])
    ends = ends - ends[0]
    points = np.frombuffer(str(data, "utf-8").encode("utf-32-le"), np.uint32)
    n, margin = len(points), max(map(len, SPECIAL_TOKENS))
    at = np.arange(n + 1) if n == len(data) else np.concatenate(([0], np.cumsum(1 + (points > 0x7F).view(np.int8) + (points > 0x7FF) + (points > 0xFFFF), dtype=np.int64)))
    rows = np.searchsorted(at, ends) if n < len(data) else ends
    kind = kinds[points]
    points = np.concatenate((points, np.zeros(margin, np.uint32)))

    edge = np.zeros(n + margin, bool)  # where a text or a special token starts or ends
    edge[rows] = True
    for first in {t[0] for t in SPECIAL_TOKENS}:
        found = np.flatnonzero(points[:n] == ord(first))
        row_end = rows[np.searchsorted(rows, found, "right")]
        for token in SPECIAL_TOKENS:
            if token[0] == first:
                here = found[_is_at(points, found, token) & (found + len(token) <= row_end)]
                kind[ranges(here, np.full(len(here), len(token)))] = SPECIAL
                edge[here] = edge[here + len(token)] = True

    start = edge.copy()
    before, now = kind[:-1], kind[1:]
    start[1:n] |= (now != before) & ~((points[: n - 1] == 0x20) & (now < SPACE))
    space = kind == SPACE
    start[1 : n - 1] |= space[:-2] & space[1:-1] & (kind[2:] < SPACE) & ~edge[2:n]
    quote = np.flatnonzero(start[:n] & (points[:n] == ord("'")))
    for end in _AFTER_APOSTROPHE:
        here = quote[_is_at(points, quote + 1, end)]
        here = here[~np.logical_or.reduce([edge[here + 1 + i] for i in range(len(end))])]
        start[here + 1] = False
        start[here + 1 + len(end)] = True

    starts = np.flatnonzero(start[:n])
    offsets = np.concatenate((at[starts], [len(data)]))
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), data]), np.searchsorted(starts, rows)


class Segmenter:
    """Ids of whole arrays of distinct pieces, by the merges of a model: the lowest rank first, then from
    the left, as :class:`qalam.functions.bytelevel.BPEEncoder` does it piece by piece."""

    def __init__(self, tokens: list[str], merges: list[tuple[str, str]]):
        number = {t: i for i, t in enumerate(tokens)}
        special = [t for t in SPECIAL_TOKENS if t in number]
        symbols, beyond = byte_to_char(), count(len(tokens))
        # strings that are no tokens get numbers beyond those, and are unknown in the end
        for text in (*symbols.values(), *(x for a, b in merges for x in (a, b, a + b))):
            if text not in number:
                number[text] = next(beyond)
        self.ids = np.full(next(beyond), number.get("<unk>", UNK_ID), np.int32)
        self.ids[: len(tokens)] = np.arange(len(tokens))
        self.of_byte = np.array([number[symbols[b]] for b in range(256)], np.int32)
        rank = {(number[a] << 32 | number[b]): i for i, (a, b) in enumerate(merges)}
        self.new = np.array([number[a + b] for a, b in merges], np.int32)
        self.keys = np.array(sorted(rank), np.int64)
        self.ranks = np.array([rank[k] for k in self.keys.tolist()], np.int32)
        every = np.arange(256)
        self.of_bytes = self._rank(self.of_byte[every[:, None]].repeat(256, 1).ravel(), self.of_byte[np.tile(every, 256)])
        # what is known: the special tokens, then words
        self.words = self.first = pa.array(special, pa.large_string())
        self.flat, self.sizes = np.array([number[t] for t in special], np.int32), np.ones(len(special), np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), _NONE, np.int32)
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def segment(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and the number of each word's."""
        _valid, offsets, data = words.buffers()
        ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if ends[0] < ends[-1] else np.zeros(0, np.uint8)
        sizes, which = np.diff(ends), np.arange(len(words))
        symbols = self.of_byte[raw]
        rank = np.full(len(raw), _NONE, np.int32)
        rank[:-1] = self.of_bytes[raw[:-1].astype(np.int32) << 8 | raw[1:]]
        some = sizes > 0
        rank[np.cumsum(sizes)[some] - 1] = _NONE
        which, left = which[some], sizes[some]
        done = []
        while len(which):
            starts = np.cumsum(left) - left
            best = np.minimum.reduceat(rank, starts)
            live = best < _NONE
            if not live.all():
                stays = np.repeat(live, left)
                done.append((which[~live], left[~live], symbols[~stays]))
                symbols, rank, which, left, best = symbols[stays], rank[stays], which[live], left[live], best[live]
                if not len(which):
                    break
                starts = np.cumsum(left) - left
            at = np.flatnonzero(rank == np.repeat(best, left))
            follows = np.flatnonzero(np.diff(at) == 1) + 1
            if len(follows):  # runs of one symbol: every other pair
                place = np.arange(len(at))
                first = np.ones(len(at), bool)
                first[follows] = False
                at = at[(place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0]
            symbols[at] = self.new[rank[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, rank = symbols[stays], rank[stays]
            word = np.searchsorted(starts, at, "right") - 1
            left -= np.bincount(word, minlength=len(left))
            ends = np.cumsum(left)
            at -= np.arange(len(at))
            rank[at] = _NONE
            inner = at[at < ends[word] - 1]
            rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
            inner = at[at > ends[word] - left[word]]
            rank[inner - 1] = self._rank(symbols[inner - 1], symbols[inner])
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        which, left, flat = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(which)
        sizes = np.zeros(len(words), np.int64)
        sizes[which] = left
        return self.ids[flat[ranges((np.cumsum(left) - left)[order], left[order])]], sizes

    def distinct(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: where each one's start in a row of ids, how many they are, and the row."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        rest = words.filter(pa.array(at < 0))
        at[at < 0] = len(self.words) + np.arange(len(rest))
        found, found_sizes = self.segment(rest)
        flat, sizes = np.concatenate((self.flat, found)), np.concatenate((self.sizes, found_sizes))
        starts = np.cumsum(sizes) - sizes
        if len(self.words) + len(rest) <= MAX_CACHED_WORDS:
            self.words, self.flat, self.sizes = pa.concat_arrays([self.words, rest]), flat, sizes
        else:  # what was not needed now is forgotten
            n = len(self.first)
            kept = np.flatnonzero(at >= n)[: MAX_CACHED_WORDS - n]
            held = np.concatenate((np.arange(n), at[kept]))
            self.words = pa.concat_arrays([self.first, words.take(pa.array(kept))])
            self.flat, self.sizes = flat[ranges(starts[held], sizes[held])], sizes[held]
        return starts[at], sizes[at], flat
