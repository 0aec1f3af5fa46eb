"""Toxicity: a counterfactual-regularised linear classifier.

A text's features are its words and their prefixes, hashed into a fixed number of buckets, each with
``log(1 + count)``. Training takes a bounded sample of labelled rows (``SAMPLE_ROWS``, the smallest
hashes of their ids): Spark counts each bucket's toxic and other texts, the buckets that tell them
apart best are kept, and a logistic regression is fitted to the sample's rows over those buckets.

Each sampled text that names a group is also taken with the name swapped for others of the same
kind. The loss adds the squared change of the raw score under each swap, so that a group's name
cannot carry a score that its neighbours don't: neutral mentions stay neutral however often the name
stands in toxic examples.

Scoring is one Arrow pass over whole texts; the model, a few kilobytes, goes with the function.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from qalam.llm.tables import id_and_text, stage, text_or_empty
from qalam.llm.word_ids import ragged, text_slices, trim_memory

#: Rows with labels that the classifier is fitted to, at most.
SAMPLE_ROWS = 20_000

#: Hash buckets, kept buckets, and texts that a kept bucket is in at least.
BUCKETS = 1 << 20
KEPT = 1_000
LEAST_TEXTS = 5

#: Words that a task remembers between batches; beyond them it starts anew.
MAX_CACHED_WORDS = 100_000

PREFIXES = (3, 4, 5, 6, 7, 8)
THRESHOLD = 0.3
L2 = 3e-4
COUNTERFACTUAL = 1.0
STEPS = 400

#: Names of groups by kind; a name is swapped for the others of its kind.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "hispanic", "african", "arab", "european"),
    ("women", "men", "girls", "boys", "femmes", "hommes", "frauen", "männer", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "femme", "homme", "frau", "mann", "mujer", "hombre"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual", "transgender"),
    ("immigrant", "refugee", "foreigner", "native", "local"),
    ("immigrants", "refugees", "foreigners", "natives", "locals"),
    ("disabled", "deaf", "blind", "autistic", "old", "young"),
)


@dataclass(frozen=True)
class Model:
    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "replace")) % BUCKETS


def word_features(word: str) -> list[int]:
    """The buckets of a lower-cased word and of its proper prefixes."""
    return [bucket(word + "$"), *(bucket(word[:k]) for k in PREFIXES if len(word) > k)]


def words_of(texts: pa.Array) -> pa.ListArray:
    return pc.split_pattern_regex(pc.utf8_lower(texts.cast(pa.large_string())), r"[^\pL\pM\pN_]+")


class Featurizer:
    """Counts, per text, the features whose bucket has a slot."""

    def __init__(self, slots: np.ndarray):
        self.slots, self.known = slots, {}

    def _of(self, word: str) -> np.ndarray:
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= MAX_CACHED_WORDS:
                self.known.clear()
            at = self.slots[word_features(word)] if word else self.slots[:0]
            got = self.known[word] = at[at >= 0]
        return got

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, slot, count), ordered by text and slot."""
        parts = words_of(texts)
        words = parts.flatten().dictionary_encode()
        of_word = [self._of(w) for w in words.dictionary.to_pylist()]
        lengths = np.fromiter(map(len, of_word), dtype=np.int64, count=len(of_word))
        flat = np.concatenate(of_word) if of_word else self.slots[:0]
        at = words.indices.to_numpy(zero_copy_only=False)
        offsets = parts.offsets.to_numpy()
        text = np.repeat(np.arange(len(parts)), np.diff(offsets))
        some = lengths[at] > 0
        at, text = at[some], text[some]
        slot = ragged(flat, (np.cumsum(lengths) - lengths)[at], lengths[at])
        size = int(self.slots.max(initial=0)) + 1
        keys, n = np.unique(np.repeat(text, lengths[at]) * size + slot, return_counts=True)
        return keys // size, keys % size, n


def slots_of(buckets: np.ndarray) -> np.ndarray:
    slots = np.full(BUCKETS, -1, dtype=np.int64)
    slots[buckets] = np.arange(len(buckets))
    return slots


def swaps_of(text: str, terms: Sequence[Sequence[str]]) -> list[str]:
    """``text`` with each kind of group it names replaced by the next of its kind, once round."""
    kind = {t: (k, i) for k, row in enumerate(terms) for i, t in enumerate(row)}
    words = words_of(pa.array([text]))[0].as_py()
    if not any(w in kind for w in words):
        return []

    def shifted(word: str, by: int) -> str:
        if word not in kind:
            return word
        k, i = kind[word]
        return terms[k][(i + by) % len(terms[k])]

    longest = max(len(terms[kind[w][0]]) for w in words if w in kind)
    return [" ".join(shifted(w, by) for w in words) for by in range(1, longest)]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: the id's CRC-32, as decimal text, is 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, toxic`` of at most ``rows`` labelled rows, staged. An id with several labels is toxic if
    one of them says so."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return stage(id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), "sample")


def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    featurizer = Featurizer(np.arange(BUCKETS))
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        for part in text_slices(batch, "text"):
            text, at, _ = featurizer.counts(part.column("text"))
            toxic = part.column("toxic").to_numpy(zero_copy_only=False)[text] > 0
            counts += [np.bincount(at[~toxic], minlength=BUCKETS), np.bincount(at[toxic], minlength=BUCKETS)]
    some = np.flatnonzero(counts.sum(axis=0))
    del featurizer
    trim_memory()
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])], ["bucket", "other", "toxic"])


def best_buckets(sample: DataFrame, kept: int) -> np.ndarray:
    """The ``kept`` buckets with the largest z-score of the log odds between toxic and other texts."""
    sizes = sample.agg(F.count_if(F.col("toxic") > 0).alias("t"), F.count_if(F.col("toxic") <= 0).alias("o")).first()
    counts = sample.select("text", "toxic").mapInArrow(_count_buckets, "bucket long, other long, toxic long")
    counts = counts.groupBy("bucket").agg(F.sum("other").alias("o"), F.sum("toxic").alias("t")).filter(f"o + t >= {LEAST_TEXTS}")
    t, o = F.col("t") + 0.5, F.col("o") + 0.5
    not_t, not_o = F.lit(sizes.t) - F.col("t") + 0.5, F.lit(sizes.o) - F.col("o") + 0.5
    z = F.abs(F.log(t / not_t) - F.log(o / not_o)) / F.sqrt(1 / t + 1 / o + 1 / not_t + 1 / not_o)
    return np.array([r.bucket for r in counts.orderBy(z.desc(), "bucket").limit(kept).collect()], dtype=np.int64)


def _rows_of(buckets: np.ndarray, terms: Sequence[Sequence[str]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurizer = Featurizer(slots_of(buckets))
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts, ids = part.column("text").to_pylist(), part.column("doc_id").to_pylist()
                labels = part.column("toxic").to_pylist()
                # each text, then its counterfactuals, whose label is left open
                all_texts, owner, label = list(texts), list(ids), list(labels)
                for t, i in zip(texts, ids, strict=True):
                    for swapped in swaps_of(t, terms):
                        all_texts.append(swapped), owner.append(i), label.append(None)
                text, slot, n = featurizer.counts(pa.array(all_texts, pa.large_string()))
                bounds = np.searchsorted(text, np.arange(len(all_texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(owner, pa.int64()),
                        pa.array(label, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(slot.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.log1p(n).astype(np.float32))),
                    ],
                    ["doc_id", "toxic", "slots", "values"],
                )

    return rows


def fit(sample: DataFrame, kept: int = KEPT, counterfactual: float = COUNTERFACTUAL, terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> Model:
    """The classifier of a staged ``training_sample``.

    Without two classes, or without a bucket, its score is the sample's share of toxic rows."""
    buckets = best_buckets(sample, kept)
    rows = sample.mapInArrow(_rows_of(buckets, terms), "doc_id long, toxic int, slots array<int>, values array<float>")
    got = rows.toPandas().sort_values("doc_id", kind="stable")
    x = np.zeros((len(got), max(1, len(buckets))), dtype=np.float32)
    for i, (slots, values) in enumerate(zip(got["slots"], got["values"], strict=True)):
        x[i, slots] = values
    labelled = got["toxic"].notna().to_numpy()
    y = (got["toxic"][labelled].to_numpy() > 0).astype(np.float64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    if not len(buckets) or y.min(initial=1) == y.max(initial=0):
        return Model(buckets[:0], np.zeros(0), float(np.log(share / (1 - share))))
    ids = got["doc_id"].to_numpy()
    original = {i: k for i, k in zip(ids[labelled], np.flatnonzero(labelled), strict=True)}
    swapped = np.flatnonzero(~labelled)
    change = x[swapped] - x[[original[i] for i in ids[swapped]]]
    return Model(buckets, *_descend(x[labelled], y, change, counterfactual))


def _descend(x: np.ndarray, y: np.ndarray, change: np.ndarray, counterfactual: float) -> tuple[np.ndarray, float]:
    """Adam on the logistic loss, an L2 term and the mean squared change of the score under swaps."""
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(np.float32) + w[-1], -50, 50)))
        error = ((p - y) / len(y)).astype(np.float32)
        g = np.append(x.T @ error + L2 * w[:-1], error.sum())
        if len(change):
            g[:-1] += counterfactual * 2 * (change.T @ (change @ w[:-1].astype(np.float32))) / len(change)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def score_of(model: Model) -> Callable[[Column], Column]:
    """The score as a function of a text column without nulls."""

    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        featurizer, parts = Featurizer(slots_of(model.buckets)), []
        for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            raw = np.full(part.num_rows, model.bias)
            if len(model.buckets):
                text, slot, n = featurizer.counts(part.column("text"))
                raw += np.bincount(text, weights=np.log1p(n) * model.weights[slot], minlength=part.num_rows)
            parts.append(1 / (1 + np.exp(-np.clip(raw, -50, 50))))
        del featurizer
        trim_memory()
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``, from its whole text alone.

    A null or empty text gets the score of a text without features. Repeated rows score alike, null
    ids stay (not held out), an empty table gives an empty result, other columns are ignored."""
    scored = id_and_text(docs).select("doc_id", score_of(model)(F.col("text")).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays under ``THRESHOLD``."""
    score = score_of(fit(training_sample(docs, labels, rows)))
    return docs.filter(score(text_or_empty(F.col("text"))) < THRESHOLD)


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Fit on the labelled rows that are not held out, score all rows of ``docs``."""
    return score_texts(docs, fit(training_sample(docs, labels, rows)))
