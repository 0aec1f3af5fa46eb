"""Quality by compression: zstandard dictionaries of good and of bad text.

Text compresses best with a dictionary of its own kind. Two dictionaries are trained, one from
labelled good text and one from bad; a text is compressed with each, and the difference of the sizes,
per byte of text, says which kind it is nearer to. A logistic curve, fitted to labelled texts that no
dictionary has seen, turns the difference into a probability.

Texts are compressed whole, in independent blocks of ``BLOCK`` bytes: a compressor that has read some
kilobytes of a text finds its matches there and no longer in the dictionary, so one frame over a long
text would judge its beginning alone.

What is fitted is bounded: at most ``SAMPLE_ROWS`` labelled rows, and of these at most
``BLOCKS_PER_CLASS`` blocks of a class for its dictionary. Scoring is one Arrow pass; the model, two
dictionaries and two numbers, goes with the function.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from qalam.llm.tables import id_and_text, stage
from qalam.llm.word_ids import text_slices, trim_memory

#: Rows with labels that the model is fitted to, at most.
SAMPLE_ROWS = 20_000

#: Blocks of one class that its dictionary is trained on, at most.
BLOCKS_PER_CLASS = 8_000

#: Bytes of a block, of a dictionary, and zstandard's level.
BLOCK = 1024
DICTIONARY = 112_640
LEVEL = 3

#: Bytes added to a text's length before division, so that a few words decide little.
SOFT_BYTES = 24

THRESHOLD = 0.3
L2 = 1e-3


@dataclass(frozen=True)
class Model:
    """Dictionaries (``b""``: one class had no text, all scores are equal) and the logistic curve."""

    good: bytes
    bad: bytes
    slope: float
    bias: float


def blocks_of(text: bytes) -> list[memoryview]:
    view = memoryview(text)
    return [view[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


class Sizer:
    """Compressed sizes of whole texts under the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = [_compressor(good), _compressor(bad)]

    def difference(self, text: bytes) -> float:
        """(size with the bad dictionary - size with the good one) per byte of the text."""
        good, bad = (sum(len(c.compress(b)) for b in blocks_of(text)) for c in self.compressors)
        return (bad - good) / (len(text) + SOFT_BYTES)


def _compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    data = zstd.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstd.ZstdCompressor(level=LEVEL, dict_data=data)


def trained_dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary; the blocks themselves where they are too few to train one."""
    try:
        return zstd.train_dictionary(DICTIONARY, blocks, level=LEVEL).as_bytes()
    except zstd.ZstdError:
        return b"".join(blocks)[-DICTIONARY:]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: 5 divides the CRC-32 of the id as decimal text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, good, for_dictionary`` of at most ``rows`` labelled rows, staged.

    An id with several labels is bad if one of them says so; of several texts of one id the least by
    hash is taken. Equal texts are all on one side of ``for_dictionary``."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
    chosen = known.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    met = id_and_text(docs).join(F.broadcast(chosen), "doc_id")
    one = met.groupBy("doc_id", "good").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t")).select("good", "t.text")
    return stage(one.withColumn("for_dictionary", F.xxhash64(F.lit("side"), "text") % 2 == 0), "sample")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            texts, good = part.column("text").cast(pa.large_binary()).to_pylist(), part.column("good").to_pylist()
            cut = [(g, bytes(b)) for t, g in zip(texts, good, strict=True) for b in blocks_of(t)]
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in cut], pa.bool_()), pa.array([b for _, b in cut], pa.binary())], ["good", "block"])


def class_blocks(sample: DataFrame, good: bool, limit: int = BLOCKS_PER_CLASS) -> list[bytes]:
    """At most ``limit`` different blocks of a class, the smallest hashes."""
    rows = sample.filter("for_dictionary").filter(F.col("good") == good).select("good", "text")
    blocks = rows.mapInArrow(_cut, "good boolean, block binary").select("block").distinct()
    return [bytes(r.block) for r in blocks.orderBy(F.xxhash64("block"), "block").limit(limit).collect()]


def difference_of(good: bytes, bad: bytes) -> Callable[[Column], Column]:
    """The size difference as a function of a text column without nulls."""

    @F.arrow_udf(DoubleType())
    def difference(texts: pa.Array) -> pa.Array:
        sizer, out = Sizer(good, bad), []
        for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            out += [sizer.difference(t) for t in part.column("text").cast(pa.large_binary()).to_pylist()]
        del sizer
        trim_memory()
        return pa.array(out, pa.float64())

    return difference


def calibrated(differences: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and bias of the logistic curve, by Newton's method; the slope isn't negative."""
    scale = float(np.abs(differences).mean()) or 1.0
    x = np.stack((differences / scale, np.ones(len(differences))), axis=1)
    w = np.array([0.0, np.log((good.sum() + 0.5) / (len(good) - good.sum() + 0.5))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - good) / len(good) + L2 * np.array([w[0], 0])
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(good) + np.diag([L2, 1e-9])
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 0.0) / scale, float(w[1])


def fit(sample: DataFrame, blocks_per_class: int = BLOCKS_PER_CLASS) -> Model:
    """The model of a staged ``training_sample``. Where a class has no text, every score is the sample's
    share of good rows."""
    good, bad = (class_blocks(sample, kind, blocks_per_class) for kind in (True, False))
    rest = sample.filter("NOT for_dictionary")
    if not good or not bad:
        n = sample.agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good")).first()
        return Model(b"", b"", 0.0, float(np.log((n.good + 0.5) / (n.n - n.good + 0.5))))
    dictionaries = trained_dictionary(good), trained_dictionary(bad)
    got = rest.select(difference_of(*dictionaries)(F.col("text")).alias("x"), "good").toPandas().sort_values(["x", "good"])
    return Model(*dictionaries, *calibrated(got["x"].to_numpy(np.float64), got["good"].to_numpy(np.float64)))


def score_of(model: Model) -> Callable[[Column], Column]:
    """The score as a function of a text column without nulls."""
    difference = difference_of(model.good, model.bad)

    def score(text: Column) -> Column:
        raw = F.lit(model.bias) if not model.good else F.lit(model.slope) * difference(text) + F.lit(model.bias)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.least(F.greatest(raw, F.lit(-50.0)), F.lit(50.0))))

    return score


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``, from its whole text alone.

    A null or empty text has difference 0. Repeated rows score alike, null ids stay (not held out), an
    empty table gives an empty result, other columns are ignored."""
    scored = id_and_text(docs).select("doc_id", score_of(model)(F.col("text")).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def compression_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Fit on the labelled rows that are not held out, score all rows of ``docs``."""
    return score_texts(docs, fit(training_sample(docs, labels, rows)))
