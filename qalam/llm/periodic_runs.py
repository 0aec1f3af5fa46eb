"""Periodic runs of words, by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period ``q``, at least ``min_repeats * q`` and
``min_words`` words long, that no neighbouring word extends keeping that period.

* Periods up to ``SHORT`` are too short for windows: a direct scan compares every word with the one
  a lag later, for all texts of a slice at once.
* Longer periods are searched scale by scale. A scale ``(low, high]`` hashes every stretch of
  ``high`` words and takes the minima of windows of such hashes. A stretch of ``high >= q`` words can
  equal another of the same run only at multiples of ``q`` (the repeated block is primitive). Two
  windows a period apart hold the same stretches, so both have the minimum of the first, ``q`` apart
  and with no equal stretch between them. Neighbouring equal minimizers whose distance is inside the
  scale are therefore seeds, and every run has one: its first window and the same one a period later
  lie in it, as ``window + high - 1 <= 2 q``.
* A seed is extended both ways by comparing words themselves, so hashes only propose.
* A stretch found at several lags has the smallest of them as its period.

Words are numbered exactly (a dictionary per slice), numbers are salted with the text, and slices are
bounded by bytes, so memory is bounded by a slice or by the longest text. Rows are independent of each
other: there is no shuffle, and a lost task is repeated alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalam.llm.shingles import mixed
from qalam.llm.tables import held, id_and_text
from qalam.llm.word_ids import text_slices, trim_memory

MIN_WORDS = 24
MIN_REPEATS = 3

#: Longest period of the direct scan; scales start there.
SHORT = 16

SLICE_BYTES = 4 << 20

RUN = "struct<start: bigint, length: bigint, period: bigint>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, best {RUN}, text string"

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """``(low, high]`` up to period ``longest``, two to an octave."""
    low = SHORT
    while low < longest:
        yield low, low + low // 2
        if low + low // 2 < longest:
            yield low + low // 2, 2 * low
        low *= 2


def joined(left: np.ndarray, by: int) -> np.ndarray:
    """Hashes of the stretches at ``i`` and ``i + by`` together; places without the latter get any."""
    out = left * _A
    out[: len(left) - by] += left[by:] * _B
    return mixed(out)


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """Places whose value is the least of some window of ``size`` neighbours."""
    least = _sliding(values, size, np.minimum)
    if not len(least):
        return np.zeros(0, np.int64)
    # a place is chosen if the largest of the minima of the windows over it is its own value
    edge = np.zeros(size - 1, values.dtype)
    return np.flatnonzero(_sliding(np.concatenate((edge, least, edge)), size, np.maximum) == values)


def _sliding(values: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    span, out = 1, values
    while 2 * span <= size:
        out = best(out[:-span], out[span:])
        span *= 2
    rest = size - span
    return best(out[:-rest], out[rest:]) if rest else out


def _reach(keys: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on, in direction ``step``, equal the word ``lag`` later."""
    found, size = 0, 64
    end = len(keys) - lag if step > 0 else -1
    while True:
        lo, hi = (at, min(at + size, end)) if step > 0 else (max(at - size + 1, 0), at + 1)
        if lo >= hi:
            return found
        differs = np.flatnonzero(keys[lo:hi] != keys[lo + lag : hi + lag])
        if len(differs):
            return found + int(differs[0] if step > 0 else hi - lo - 1 - differs[-1])
        found += hi - lo
        at += step * (hi - lo)
        size *= 2


def _scanned(keys: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal stretches of period ``lag`` and ``least`` words or more."""
    same = np.flatnonzero(keys[lag:] == keys[:-lag]) if len(keys) > lag else np.zeros(0, np.int64)
    if len(same) < least - lag:
        return same[:0], same[:0]
    breaks = np.flatnonzero(np.diff(same) > 1)
    first, last = np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [len(same) - 1]))
    length = last - first + 1 + lag
    long = length >= least
    return same[first[long]], length[long]


def find_runs(keys: np.ndarray, n_words: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """Rows ``start, length, period`` of every run, by start and period.

    ``keys`` are the words of all texts in a row, no word of one text equal to a word of another."""
    if min_repeats < 3:
        raise ValueError("a run's period is only certain from three repeats on")
    found = []
    for lag in range(1, SHORT + 1):
        starts, lengths = _scanned(keys, lag, max(min_words, min_repeats * lag))
        found.append(np.stack((starts, lengths, np.full(len(starts), lag)), axis=1))
    sizes = n_words
    hashes, level, places = keys, 1, None
    for low, high in scales(int(n_words.max(initial=0)) // min_repeats):
        # texts that can hold such a run; the others' words leave the arrays
        able = sizes >= min_repeats * (low + 1)
        if not able.all():
            stay = np.repeat(able, sizes)
            places = np.flatnonzero(stay) if places is None else places[stay]
            hashes, sizes = hashes[stay], sizes[able]
        while 2 * level <= low:
            hashes, level = joined(hashes, level), 2 * level
        grams = joined(hashes, high - level)
        grams = grams[: max(0, len(grams) - high + 1)]
        chosen = window_minima(grams, 2 * low + 3 - high)
        order = chosen[np.argsort(grams[chosen], kind="stable")]
        gap = np.diff(order)
        seeds = np.flatnonzero((grams[order[1:]] == grams[order[:-1]]) & (gap > low) & (gap <= high))
        if len(seeds):
            where = order[seeds] if places is None else places[order[seeds]]
            found.append(_extended(keys, where, gap[seeds], min_words, min_repeats))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (np.diff(runs[:, 0]) != 0) | (np.diff(runs[:, 1]) != 0)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _extended(keys: np.ndarray, at: np.ndarray, lags: np.ndarray, min_words: int, min_repeats: int) -> np.ndarray:
    out, done = [], (0, 0)
    for k in np.lexsort((at, lags)):
        place, lag = int(at[k]), int(lags[k])
        if done[0] == lag and place < done[1]:
            continue
        right = _reach(keys, place, lag, 1)
        start = place - _reach(keys, place - 1, lag, -1) if right else place
        done = lag, place + max(right, 1)
        if place + right - start + lag >= max(min_words, min_repeats * lag):
            out.append((start, place + right - start + lag, lag))
    return np.array(out, np.int64).reshape(-1, 3)


def _runs_of_slices(min_words: int, min_repeats: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                yield _runs_of_slice(part, min_words, min_repeats)
        trim_memory()

    return of_batches


def _runs_of_slice(part: pa.RecordBatch, min_words: int, min_repeats: int) -> pa.RecordBatch:
    # bytes split at the white space of ASCII alone
    texts = [t.split() for t in part.column("text").cast(pa.large_binary()).to_pylist()]
    n_words = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate(([0], np.cumsum(n_words)))
    numbers = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode().indices
    salt = np.repeat(np.arange(len(texts), dtype=np.uint64) << np.uint64(32), n_words)
    runs = find_runs(mixed(numbers.to_numpy(zero_copy_only=False).astype(np.uint64) + salt), n_words, min_words, min_repeats)
    owner = np.searchsorted(bounds, runs[:, 0], side="right") - 1
    best, out = [None] * len(texts), [b" ".join(t) for t in texts]
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i in np.unique(owner):
        own = runs[ends[i] : ends[i + 1]] - [bounds[i], 0, 0]
        start, length, period = max(own.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
        best[i] = {"start": start, "length": length, "period": period}
        # inside some run after its first period: more such stretches begun than ended
        depth = np.zeros(n_words[i] + 1, np.int64)
        np.add.at(depth, own[:, 0] + own[:, 2], 1)
        np.add.at(depth, own[:, 0] + own[:, 1], -1)
        out[i] = b" ".join([texts[i][k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)])
    starts = runs[:, 0] - bounds[owner]
    listed = pa.StructArray.from_arrays([pa.array(starts), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.array(n_words),
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), listed),
            pa.array(best, pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])),
            pa.array(out, pa.binary()).cast(pa.string()),
        ],
        ["doc_id", "n_words", "runs", "best", "text"],
    )


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """``doc_id, n_words, runs, best, text`` for every row of ``docs``, from its whole text.

    ``runs`` are by start and period, counted in words from 0; ``best`` is the one with the largest
    length in periods (ties: least start, then period), null without runs; ``text`` has the words that
    no run repeats, one space apart. A null or empty text has no words and an empty text, repeated
    rows come back alike, null ids stay, an empty table gives an empty result, other columns are
    ignored."""
    return id_and_text(docs).mapInArrow(_runs_of_slices(min_words, min_repeats), SCHEMA)


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, with the end of some texts replaced by repetitions: where 10 divides the
    CRC-32 ``h`` of the decimal id and there are ``n > 0`` words, each word from ``a`` on becomes word
    ``a + (i - a) % p``, with ``g = h div 10``, ``a = g % n`` and ``p = 1 + (n - a) div (3 + g % 8)``.
    Texts of other ids, and of null ids, stay."""
    white = r"[\x20\x09-\x0D]+"
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = id_and_text(docs).select("doc_id", "text", F.when(h % 10 == 0, F.floor(h / 10)).alias("g"))
    words = F.filter(F.split("text", white), lambda w: w != "")
    split = chosen.select("doc_id", "text", "g", held(F.when(F.col("g").isNotNull(), words)).alias("words"))
    ends = split.withColumn("a", held(F.expr("IF(size(words) > 0, g % size(words), NULL)")))
    ends = ends.withColumn("p", held(F.expr("1 + (size(words) - a) DIV (3 + g % 8)")))
    tail = F.expr("array_join(transform(words, (w, i) -> IF(i < a, w, words[CAST(a + (i - a) % p AS INT)])), ' ')")
    return ends.select("doc_id", F.when(F.col("a").isNotNull(), tail).otherwise(F.col("text")).alias("text"))


def run_lines(runs: Column) -> Column:
    """Every run as ``start,length,period`` and a line feed."""
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))))
