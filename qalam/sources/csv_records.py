"""Records of large CSV files with line breaks inside quoted cells, read by many tasks.

Spark's multi-line reader gives a file to one task, as only a scan from its start knows which line breaks
are inside quotes. Whether a line starts inside quotes depends on the number of quotes before it being odd,
and a doubled quote doesn't change that. So:

1. The lines of every split are read in parallel; one row per split counts its quotes.
2. A prefix of the parities over each file's splits tells how every split starts.
3. Each task goes through its splits' lines once more and joins those of a record. What a split's first
   record began in an earlier split, and what its last record leaves open, are pieces.
4. Pieces, at most two per split, are put together by the split that their record began in.

Records are parsed by ``from_csv``, with the options of the reader. Line breaks inside cells stay as they
are in the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, CLOSING, THROUGH, OPEN = range(4)

_PIECES = "file string, block long, kind int, first boolean, record string"


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, line`` in the files' order within each partition."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def split_starts(lines: DataFrame) -> DataFrame:
    """``file, block, inside``: whether a split starts inside quotes. One row per split."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Split:
    """The lines of one split, in order, as records and pieces."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.inside = file, block, inside
        self.held, self.began, self.any = [], inside, False

    def records(self, lines: pa.Array) -> pa.RecordBatch:
        """The records that are closed by ``lines``; the rest is held."""
        if self.held:
            lines = pa.concat_arrays([*self.held, lines])
        odd = np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)) % 2 == 1
        after = odd ^ self.began
        ends = np.flatnonzero(~after) + 1
        cut = int(ends[-1]) if len(ends) else 0
        self.held = [lines.slice(cut)] if cut < len(lines) else []
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines.slice(0, cut)), "\n")
        kinds = np.full(len(joined), WHOLE, np.int32)
        first = np.zeros(len(joined), bool)
        if len(joined):
            if self.began and not self.any:
                kinds[0] = CLOSING
            first[0] = self.block == 0 and not self.any
            self.any, self.began = True, False
        return self._batch(joined, kinds, first)

    def rest(self) -> pa.RecordBatch:
        """What is open at the split's end."""
        lines = pa.concat_arrays(self.held) if self.held else pa.array([], pa.string())
        n = 1 if len(lines) else 0
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)][: n + 1], pa.int32()), lines), "\n")
        through = self.inside and not self.any
        return self._batch(joined, np.full(n, THROUGH if through else OPEN, np.int32), np.full(n, self.block == 0 and not self.any))

    def _batch(self, records: pa.Array, kinds: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        n = len(records)
        columns = [pa.array([self.file] * n, pa.string()), pa.array([self.block] * n, pa.int64()), pa.array(kinds), pa.array(first), records]
        return pa.RecordBatch.from_arrays(columns, ["file", "block", "kind", "first", "record"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
        new = np.flatnonzero((np.diff(files.indices.to_numpy()) != 0) | (np.diff(blocks) != 0)) + 1
        bounds = [0, *new.tolist(), batch.num_rows]
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if lo == hi:
                continue
            file, block = batch.column("file")[lo].as_py(), int(blocks[lo])
            if now is None or (now.file, now.block) != (file, block):
                if now is not None:
                    yield now.rest()
                now = _Split(file, block, batch.column("inside")[lo].as_py())
            yield now.records(batch.column("line").slice(lo, hi - lo).cast(pa.string()))
    if now is not None:
        yield now.rest()


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``first, record``: every record of the CSV files under ``path`` as text, without the end of its last
    line; ``first`` marks the first one of each file. Empty lines between records are left out."""
    lines = split_lines(spark, path)
    # one row per split on the broadcast side; the lines keep their order
    told = lines.join(F.broadcast(split_starts(lines)), ["file", "block"]).select("file", "block", "inside", "line")
    found = told.mapInArrow(_joined, _PIECES)
    order = Window.partitionBy("file").orderBy("block", "kind")
    pieces = found.where(F.col("kind") != WHOLE).withColumn("chain", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
    parts = pieces.groupBy("file", "chain").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"), F.bool_or("first").alias("first"))
    whole = parts.select("first", F.array_join(F.transform("parts", lambda p: p.record), "\n").alias("record"))
    records = found.where(F.col("kind") == WHOLE).select("first", "record").unionByName(whole)
    return records.select("first", F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")
