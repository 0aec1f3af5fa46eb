"""Byte-level BPE vocabulary training over a distributed word table.

1. ``pretoken_counts``: pre-tokenisation and counting by built-in functions -> the word table
   ``(word, n)``, words in byte symbols.
2. ``train_bpe``: words become runs of symbol ids, written as versions of a word table. A version
   starts with one job that counts all pairs; the ``top_k`` most frequent reach the driver.
3. The first of them, P, are merged together with what they grow into. The tasks cut the words where two
   neighbours are no pair of P and count the distinct stretches; the driver merges in these, one pair
   after the other in the trainer's order. A merged symbol is always made of the same symbols of the
   version, so all places of a pair have the same two symbols of the version at its seam: they are in P,
   and all places are inside stretches, where the count is exact; or they aren't, and the pair comes
   after the seam in the trainer's order (its count is at most the seam's, its ids are at least the
   seam's), so after the first pair left out of P. Merges thus are exact until the best pair of the
   stretches comes after that one. The next version replaces the stretches by what became of them.
4. P is as large as ``held_words`` distinct stretches allow. Where those of a few pairs are too many, a
   version is made by a batch of merges in the tasks. Merging ``(a, b)`` changes the counts of exactly
   the pairs that *chain* with it -- ``(x, a)`` and ``(b, y)`` -- and creates pairs bounded by such a
   chain pair's count. Pairs that merely share a symbol occupy disjoint positions. So the prefix of the
   exact top list (count desc, ids asc) up to the first pair that chains with an accepted one is what
   one-at-a-time BPE picks: every pair that the batch touches sits after the stop in that order, and a
   created pair never wins a tie because the new symbol's id is larger than every existing id. A
   self-pair ``(a, a)`` ends the batch.

A merge whose string already is a token ends a version in both: like the library trainer it maps to that
token's id instead of adding one, so pairs that hold that id may grow.

What reaches the driver is bounded by ``top_k``, ``held_words`` and ``vocab_size``, whatever the corpus.
"""

from __future__ import annotations

import heapq
import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalam.functions.bytelevel import PRETOKEN_PATTERN, SPECIAL_TOKENS, alphabet, byte_to_char
from qalam.functions.ranges import ranges
from qalam.session import scratch_path

MAX_VOCAB = 1_000_000

#: Pairs whose counts reach the driver when a version starts, and distinct stretches that it holds at a
#: time, of this many symbols on average.
TOP_K = 20_000
HELD_WORDS = 100_000
HELD_SYMBOLS = 16

#: Pairs whose stretches are asked for at first, and the fewest that are worth it.
FIRST_PAIRS = 64
WORTH = 8

#: A pair of ids as one number; ids stay below ``1 << SHIFT``.
SHIFT = 20
MASK = (1 << SHIFT) - 1

#: Batches of merges that are replayed on a version before the next one is written.
REPLAYED = 8

_LOG = logging.getLogger("qalam.bpe")


@dataclass
class BPEModel:
    """Vocabulary in id order and merges in rank order (token strings in byte-symbol form)."""

    tokens: list[str]
    merges: list[tuple[str, str]] = field(default_factory=list)
    rounds: int = 0

    @property
    def vocab(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.tokens)}

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        rows = [(t, i, i < len(SPECIAL_TOKENS)) for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "token string, id int, special boolean")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, a, b) for i, (a, b) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string")

    def encoder(self):
        from qalam.functions.bytelevel import BPEEncoder

        return BPEEncoder(self.vocab, self.merges)


#: The pre-tokenisation pattern for Java: white space as Unicode has it, and possessive runs, so that a
#: long run of one class takes no stack. White space before a word is left to it, as the pattern's
#: look-ahead says, which a possessive run could not do.
_SPACES = r"\s+(?!\S)|\s+"
JAVA_PATTERN = "(?U)" + PRETOKEN_PATTERN.removesuffix(_SPACES).replace("+|", "++|") + _SPACES


def pretoken_counts(df: DataFrame, text_cols: list[str]) -> DataFrame:
    """Word frequencies after byte-level pre-tokenisation of ``text_cols``: ``(word, n)``.

    Words are cut and counted as text by built-in functions; the bytes of each distinct word, read as
    Latin-1, are then translated to their symbols."""
    pieces = F.concat(*[F.regexp_extract_all(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(JAVA_PATTERN), F.lit(0)) for c in text_cols])
    counts = df.select(F.explode(pieces).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    moved = [(chr(b), c) for b, c in byte_to_char().items() if chr(b) != c]
    latin = F.decode(F.encode("piece", "UTF-8"), "ISO-8859-1")
    return counts.select(F.translate(latin, "".join(b for b, _ in moved), "".join(c for _, c in moved)).alias("word"), "n")


def select_batch(top: list[tuple[int, int, int]], min_frequency: int, room: int) -> list[tuple[int, int, int]]:
    """Exact merge batch from the exact top pairs ``(a, b, count)`` sorted by count desc, then
    ``a``, ``b`` ascending (see module docstring)."""
    accepted: list[tuple[int, int, int]] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    for a, b, c in top:
        if len(accepted) >= room or c < min_frequency:
            break
        if b in lefts or a in rights:  # chains with an accepted merge: its count is stale
            break
        accepted.append((a, b, c))
        if a == b:
            break
        lefts.add(a)
        rights.add(b)
    return accepted


Batch = list[tuple[int, int, int]]


def _symbols(segs: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words in a row, and the number of symbols of each word."""
    if not len(segs):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    _valid, offsets, data = segs.buffers()
    offsets = np.frombuffer(offsets, np.int32)[segs.offset : segs.offset + len(segs) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(np.int32), np.diff(offsets) // 4


def _segs(symbols: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """Words of the given sizes, the inverse of :func:`_symbols`."""
    offsets = np.concatenate(([0], 4 * np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(symbols.astype(np.int32))])


def _flat(segs: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All words' symbols in a row, each word ended by -1, and the number of symbols of each word."""
    values, sizes = _symbols(segs)
    return np.insert(values.astype(np.int64), np.cumsum(sizes), -1), sizes


def _pairs(flat: np.ndarray) -> np.ndarray:
    """The pair that starts at each symbol; negative where a word ends."""
    keys = np.full(len(flat), -1, np.int64)
    inside = flat[:-1] >= 0
    inside &= flat[1:] >= 0
    keys[:-1][inside] = flat[:-1][inside] << SHIFT | flat[1:][inside]
    return keys


def apply_batch(flat: np.ndarray, batch: Batch) -> np.ndarray:
    """``flat`` after a batch of merges ``(a, b, new)`` that don't chain; a self-pair is taken from the
    left, without overlaps."""
    order = np.argsort([a << SHIFT | b for a, b, _new in batch])
    wanted = np.array([a << SHIFT | b for a, b, _new in batch], np.int64)[order]
    new = np.array([x for _a, _b, x in batch], np.int64)[order]
    keys = _pairs(flat)
    at = np.searchsorted(wanted, keys)
    at[at == len(wanted)] = 0
    hits = np.flatnonzero(wanted[at] == keys)
    a, b, _new = batch[-1]
    if a == b:
        own = hits[keys[hits] == (a << SHIFT | a)]
        first = np.concatenate(([True], np.diff(own) != 1))[: len(own)]
        place = np.arange(len(own))
        odd = (place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 1
        hits = np.setdiff1d(hits, own[odd], assume_unique=True)
    out = flat.copy()
    out[hits] = new[at[hits]]
    stay = np.ones(len(out), bool)
    stay[hits + 1] = False
    return out[stay]


def _words_after(batches: list[Batch]) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]:
    def after(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = _flat(batch.column("seg"))
        for merges in batches:
            flat = apply_batch(flat, merges)
        ends = np.flatnonzero(flat < 0)
        return flat, np.diff(ends, prepend=-1) - 1 if len(ends) else sizes

    return after


def _counter(batches: list[Batch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pair counts of a task's words, after ``batches``."""
    after = _words_after(batches)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in rows:
            flat, sizes = after(batch)
            keys = _pairs(flat)
            weights = np.repeat(batch.column("n").to_numpy(zero_copy_only=False), sizes + 1)
            parts.append(_summed(keys[keys >= 0], weights[keys >= 0]))
        if parts:
            k, c = _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], ["k", "c"])

    return count


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], np.diff(keys) != 0))[: len(keys)])
    if not len(starts):
        return keys, counts[:0]
    return keys[starts], np.add.reduceat(counts[order], starts)


def _advance(batches: list[Batch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The words after ``batches`` that still have pairs."""
    after = _words_after(batches)

    def advance(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            yield _left(*after(batch), batch.column("n"))

    return advance


def _left(flat: np.ndarray, sizes: np.ndarray, n: pa.Array) -> pa.RecordBatch:
    """The words that still have pairs."""
    stay = sizes > 1
    segs = _segs(flat[np.repeat(stay, sizes + 1) & (flat >= 0)], sizes[stay])
    return pa.RecordBatch.from_arrays([n.filter(pa.array(stay)), segs], ["n", "seg"])


def _stretches(flat: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of symbols whose neighbours are pairs of ``joined`` (sorted)."""
    keys = _pairs(flat)
    at = np.searchsorted(joined, keys)
    at[at == len(joined)] = 0
    linked = joined[at] == keys
    starts = np.flatnonzero(linked & ~np.concatenate(([False], linked[:-1])))
    ends = np.flatnonzero(linked & ~np.concatenate((linked[1:], [False])))
    return starts, ends - starts + 2


def _stretch_counter(batches: list[Batch], joined: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Distinct stretches of each batch of words, after ``batches``, and how often they occur."""
    after = _words_after(batches)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            flat, sizes = after(batch)
            starts, lengths = _stretches(flat, joined)
            found = _segs(flat[ranges(starts, lengths)], lengths).dictionary_encode()
            n = np.zeros(len(found.dictionary), np.int64)
            word = np.repeat(np.arange(len(sizes)), sizes + 1)[starts]
            np.add.at(n, found.indices.to_numpy(zero_copy_only=False), batch.column("n").to_numpy(zero_copy_only=False)[word])
            yield pa.RecordBatch.from_arrays([found.dictionary, pa.array(n)], ["stretch", "n"])

    return count


def _replacer(batches: list[Batch], joined: np.ndarray, changed) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The words after ``batches`` that still have pairs when the stretches in ``changed`` (a broadcast
    dictionary) are replaced."""
    after = _words_after(batches)

    def replace(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            flat, _sizes = after(batch)
            starts, lengths = _stretches(flat, joined)
            found = _segs(flat[ranges(starts, lengths)], lengths).dictionary_encode()
            values, sizes = _symbols(pa.array([changed.value.get(x, x) for x in found.dictionary.to_pylist()], pa.binary()))
            which = found.indices.to_numpy(zero_copy_only=False)
            now = sizes[which]
            flat[ranges(starts, now)] = values[ranges((np.cumsum(sizes) - sizes)[which], now)]
            stay = np.ones(len(flat), bool)
            stay[ranges(starts + now, lengths - now)] = False
            flat = flat[stay]
            yield _left(flat, np.diff(np.flatnonzero(flat < 0), prepend=-1) - 1, batch.column("n"))

    return replace


#: A word: how often it occurs, and its symbols as 32-bit numbers.
WORDS = "n long, seg binary"


class _Version:
    """The word table at some merge, with the batches that have been decided since."""

    def __init__(self, words: DataFrame):
        spark, path = words.sparkSession, scratch_path(words.sparkSession, "bpe-words")
        words.write.parquet(path)
        self.words, self.batches = spark.read.schema(WORDS).parquet(path), []

    def top(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs and counts of the ``k`` most frequent pairs (ties: smallest ids)."""
        pairs = self.words.mapInArrow(_counter(self.batches), "k long, c long")
        got = pairs.groupBy("k").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "k").limit(k).toArrow()
        return tuple(got.column(c).to_numpy() for c in ("k", "c"))

    def merged(self, batch: Batch) -> "_Version":
        self.batches.append(batch)
        return _Version(self.words.mapInArrow(_advance(self.batches), WORDS)) if len(self.batches) >= REPLAYED else self

    def stretches(self, joined: np.ndarray, most: int) -> pa.Table | None:
        """The distinct stretches of pairs ``joined`` and their counts; None if they are more than ``most``."""
        parts = self.words.mapInArrow(_stretch_counter(self.batches, joined), "stretch binary, n long")
        found = parts.groupBy("stretch").agg(F.sum("n").alias("n")).persist()
        try:
            size = found.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("stretch")), F.lit(0)).alias("bytes")).first()
            return found.toArrow() if size.rows <= most and size.bytes <= 4 * HELD_SYMBOLS * most else None
        finally:
            found.unpersist()

    def replaced(self, joined: np.ndarray, changed: dict[bytes, bytes]) -> "_Version":
        """The version in which stretches (at most as many as are held) have other symbols."""
        sent = self.words.sparkSession.sparkContext.broadcast(changed)
        try:
            return _Version(self.words.mapInArrow(_replacer(self.batches, joined, sent), WORDS))
        finally:
            sent.unpersist()


class _Held:
    """Stretches on the driver and the counts of the pairs in them, as far as they come before the pair
    ``rest`` of ``floor`` places in the trainer's order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, floor: int, rest: int, stretches: pa.Table):
        self.counts = dict(zip(keys.tolist(), counts.tolist(), strict=True))
        self.heap = [(-c, k) for k, c in self.counts.items()]
        heapq.heapify(self.heap)
        self.floor, self.rest = floor, rest
        self.raw = stretches.column("stretch").to_pylist()
        self.words = [np.frombuffer(x, np.int32).tolist() for x in self.raw]
        self.n = stretches.column("n").to_pylist()
        self.where: dict[int, set[int]] = {}
        self.changed: set[int] = set()
        for i, seg in enumerate(self.words):
            for x, y in zip(seg, seg[1:], strict=False):
                self.where.setdefault(x << SHIFT | y, set()).add(i)

    def best(self) -> tuple[int, int] | None:
        """The most frequent pair and its count, None where one outside the stretches may come before."""
        while self.heap:
            count, key = -self.heap[0][0], self.heap[0][1]
            if self.counts.get(key) == count:
                return (key, count) if (-count, key) < (-self.floor, self.rest) else None
            heapq.heappop(self.heap)
        return None

    def merge(self, a: int, b: int, new: int) -> None:
        """Merge the pair in every stretch that holds it and carry the counts on."""
        change: dict[int, int] = {}
        for i in self.where.pop(a << SHIFT | b, ()):
            n, seg = self.n[i], self.words[i]
            after, j, last = [], 0, len(seg) - 1
            while j <= last:
                if j < last and seg[j] == a and seg[j + 1] == b:
                    after.append(new)
                    j += 2
                else:
                    after.append(seg[j])
                    j += 1
            if len(after) == len(seg):
                continue
            for x, y in zip(seg, seg[1:], strict=False):
                k = x << SHIFT | y
                change[k] = change.get(k, 0) - n
            for x, y in zip(after, after[1:], strict=False):
                k = x << SHIFT | y
                change[k] = change.get(k, 0) + n
                if x == new or y == new:
                    self.where.setdefault(k, set()).add(i)
            self.words[i] = after
            self.changed.add(i)
        for k, delta in change.items():
            if delta:
                self.counts[k] = count = self.counts.get(k, 0) + delta
                if count >= self.floor:
                    heapq.heappush(self.heap, (-count, k))
        self.counts.pop(a << SHIFT | b, None)

    def became(self) -> dict[bytes, bytes]:
        return {self.raw[i]: np.array(self.words[i], np.int32).tobytes() for i in self.changed}


def _train(version: _Version, model: "BPEModel", vocab_size: int, min_frequency: int, top_k: int, held_words: int) -> None:
    id_of = {t: i for i, t in enumerate(model.tokens)}

    def merge(a: int, b: int) -> tuple[int, bool]:
        """The id of the merged pair, and whether it is a new one."""
        text = model.tokens[a] + model.tokens[b]
        model.merges.append((model.tokens[a], model.tokens[b]))
        if text in id_of:
            return id_of[text], False
        id_of[text] = len(model.tokens)
        model.tokens.append(text)
        return id_of[text], True

    pairs = FIRST_PAIRS
    while len(model.tokens) < vocab_size:
        started = time.monotonic()
        keys, counts = version.top(top_k)
        model.rounds += 1
        top = list(zip((keys >> SHIFT).tolist(), (keys & MASK).tolist(), counts.tolist(), strict=True))
        batch = select_batch(top, min_frequency, vocab_size - len(model.tokens))
        if not batch:
            return
        # a full list may go on beyond its end
        some, found = min(pairs, len(keys) - (len(keys) == top_k)), None
        while held_words and some:
            joined = np.sort(keys[:some])
            found = version.stretches(joined, held_words)
            if found is not None or some <= WORTH:
                break
            some = max(WORTH, some // 4)
        if found is None:
            applied = []
            for a, b, _c in batch:
                new, fresh = merge(a, b)
                applied.append((a, b, new))
                if not fresh:
                    break
            version = version.merged(applied)
            _LOG.debug("%d tokens: batch of %d, %.2f s", len(model.tokens), len(applied), time.monotonic() - started)
            continue
        pairs = max(WORTH, int(some * min(8, held_words / (2 * max(1, found.num_rows)))))
        whole = some == len(keys)
        held = _Held(keys[:some], counts[:some], 0 if whole else int(counts[some]), 0 if whole else int(keys[some]), found)
        fresh, before = True, len(model.merges)
        while fresh and len(model.tokens) < vocab_size:
            best = held.best()
            if best is None or best[1] < min_frequency:
                break
            a, b = best[0] >> SHIFT, best[0] & MASK
            new, fresh = merge(a, b)
            held.merge(a, b, new)
        _LOG.debug("%d tokens: %d merges, %d pairs, %d stretches, %.2f s", len(model.tokens), len(model.merges) - before, some, found.num_rows, time.monotonic() - started)
        if best is None and whole or best is not None and best[1] < min_frequency:
            return
        if len(model.tokens) < vocab_size:
            version = version.replaced(joined, held.became())


def train_bpe(
    words: DataFrame,
    vocab_size: int = 32_000,
    min_frequency: int = 2,
    top_k: int = TOP_K,
    num_partitions: int | None = None,
    held_words: int = HELD_WORDS,
) -> BPEModel:
    """Train merges on a word table ``(word, n)`` until ``vocab_size`` or no pair reaches
    ``min_frequency``. Specials take ids 0-5, the 256 byte symbols 6-261.

    ``top_k`` and ``held_words`` bound what the driver holds; the result doesn't depend on them."""
    from qalam.session import ship_package

    if vocab_size > MAX_VOCAB:
        raise ValueError(f"vocab_size above {MAX_VOCAB}")
    spark = words.sparkSession
    ship_package(spark)
    tokens = list(SPECIAL_TOKENS) + alphabet()
    model = BPEModel(tokens=tokens)
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = words.select(F.col("n").cast("long").alias("n"), "word").repartition(n_parts, "word")
    _train(_Version(base.mapInArrow(_spelled(tokens), WORDS)), model, vocab_size, min_frequency, top_k, held_words)
    return model


def _spelled(tokens: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words of two byte symbols and more as ids. (A filter on the word before the tasks would be pushed below
    the counting of the words, and their symbols made for each place that they stand at.)"""
    singles = {ord(t): i for i, t in enumerate(tokens) if len(t) == 1}
    ids = np.zeros(max(singles) + 1, np.int32)
    ids[list(singles)] = list(singles.values())

    def spell(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lengths = pc.fill_null(pc.utf8_length(batch.column("word")), 0)
            batch = batch.filter(pc.greater(lengths, 1))
            word = batch.column("word")
            points = np.frombuffer("".join(word.to_pylist()).encode("utf-32-le"), np.uint32)
            yield pa.RecordBatch.from_arrays([batch.column("n"), _segs(ids[points], pc.utf8_length(word).to_numpy(zero_copy_only=False))], ["n", "seg"])

    return spell
