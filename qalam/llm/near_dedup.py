"""Near-duplicate classes by consistent weighted sampling.

1. ``frequent_shingles``: exact document counts of the five-word shingles that are in at least
   ``MIN_SHARE`` of all documents. Shingles are first counted by hash cell, and those in cells that hold
   enough of them then by themselves. Other shingles have the largest inverse document frequency.
2. ``signatures``: improved consistent weighted sampling (Ioffe) of each text's shingles, weighted by
   term frequency times inverse document frequency; ``ROWS`` samples make a band. Equal texts are one
   from here on.
3. Texts that share a band are candidates. In every bucket one text, the one that shares most buckets
   with others, is compared with the rest, so that a bucket of near copies takes as many comparisons
   as it has members.
4. Where a bucket still spans several classes, its members outside the largest class are compared
   with all of it, in blocks of bounded size; a block yields links, not pairs.
5. Every link is verified by the exact weighted Jaccard similarity of whole texts. Classes are the
   connected components of the links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalam.llm.components import connected_components
from qalam.llm.shingles import KEY_BITS, mixed, shingle_slices, shingles
from qalam.llm.tables import id_and_text, shuffle_partitions, stage, text_or_empty
from qalam.llm.word_ids import trim_memory

#: Similarity that makes two texts near copies.
THRESHOLD = 0.8

#: Bands and samples in each. At the threshold a pair shares a band with probability 0.9994.
BANDS, ROWS = 14, 4

#: Share of all documents from which on a shingle's weight falls. Rarer ones weigh the same: what tells two
#: near copies apart is always rare, and the copies of a large group would drift apart by their own number.
MIN_SHARE = 0.003

#: Hash cells of the candidate search, and cells whose counts travel together. A cell holds far less than
#: ``MIN_SHARE`` of ordinary shingles.
CELL_BITS, CHUNK_BITS = 22, 12

#: Texts, and characters of them, of a block on either side of a comparison: whichever is less. What
#: a task holds at a time follows from them, not from the length of the texts.
BLOCK, BLOCK_CHARS = 400, 1 << 20


@dataclass(frozen=True)
class Frequencies:
    """Weights of frequent shingles (sorted by hash) and of all others."""

    keys: np.ndarray
    weights: np.ndarray
    other: float

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), self.other)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.weights[at], self.other)


def text_key(text: Column) -> Column:
    """128 bits of the text's SHA-256: the identity of a text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts' shingles are in each cell, a task's cells in chunks: places and counts."""
    found = np.zeros(1 << CELL_BITS, dtype=np.int32)
    for batch in batches:
        for part in shingle_slices(batch):
            _, keys, _ = shingles(part.column("text"))
            cells, n = np.unique(keys >> np.uint64(KEY_BITS - CELL_BITS), return_counts=True)
            found[cells.astype(np.int64)] += n.astype(np.int32)
    some = np.flatnonzero(found)
    bounds = np.searchsorted(some, np.arange(0, (1 << CELL_BITS) + 1, 1 << CHUNK_BITS))
    chunks = np.flatnonzero(np.diff(bounds))
    places = [(some[bounds[c] : bounds[c + 1]] & ((1 << CHUNK_BITS) - 1)).astype("<u2").tobytes() for c in chunks]
    counts = [found[some[bounds[c] : bounds[c + 1]]].astype("<i4").tobytes() for c in chunks]
    trim_memory()
    yield pa.RecordBatch.from_arrays([pa.array(chunks), pa.array(places, pa.binary()), pa.array(counts, pa.binary())], ["chunk", "places", "counts"])


def _full_cells(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, places, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "places", "counts")), strict=True):
                sums = total.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.int64))
                sums[np.frombuffer(places, "<u2")] += np.frombuffer(counts, "<i4")
        cells = [(chunk << CHUNK_BITS) + np.flatnonzero(sums >= least) for chunk, sums in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells) if cells else np.zeros(0, np.int64))], ["cell"])

    return full


def _counts(cells: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << CELL_BITS, dtype=bool)
        wanted[cells] = True
        for batch in batches:
            for part in shingle_slices(batch):
                _, keys, _ = shingles(part.column("text"))
                keys, n = np.unique(keys[wanted[(keys >> np.uint64(KEY_BITS - CELL_BITS)).astype(np.int64)]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], ["shingle", "n"])
        trim_memory()

    return count


def frequent_shingles(docs: DataFrame, min_share: float = MIN_SHARE) -> Frequencies:
    """Weights by the document counts of all of ``docs``.

    At most (mean shingles per document / ``min_share``) cells, and as many shingles, reach the driver,
    whatever the number of documents."""
    texts = id_and_text(docs).select("text")
    total = texts.count()
    chunks = texts.mapInArrow(_cells, "chunk long, places binary, counts binary").repartition(shuffle_partitions(docs.sparkSession), "chunk")
    cells = chunks.mapInArrow(_full_cells(max(1.0, min_share * total)), "cell long").toArrow().column("cell").to_numpy()
    counts = texts.mapInArrow(_counts(cells), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") >= F.lit(min_share * total)).orderBy("shingle").toArrow()
    keys = rows.column("shingle").to_numpy().astype(np.uint64)
    share = rows.column("n").to_numpy() / max(1, total)
    return Frequencies(keys, 1 - np.log(np.maximum(share, min_share)), float(1 - np.log(min_share)))


_UNIT = np.uint64(0xD6E8FEB86659FD93)


def weighted_samples(
    text: np.ndarray, keys: np.ndarray, weights: np.ndarray, samples: int
) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have shingles, and for each the hash value of every sample's smallest element.

    Sample k draws, for each shingle, r and c from Gamma(2, 1) and b uniformly, all from a hash of the
    shingle; the element with the smallest c / exp(r * (floor(ln w / r + b) - b + 1)) is taken. That
    value is a function of the shingle and its quantised weight, so it also names the element."""
    logs = -np.log((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    out = np.empty((len(starts), samples), dtype=np.float32)
    if not len(starts):
        return text[:0], out
    log_weight = np.log(weights).astype(np.float32)
    base = mixed(keys + np.uint64(1))
    for k, seed in enumerate(mixed(np.arange(1, samples + 1, dtype=np.uint64))):
        z = (base ^ seed) * _UNIT
        z ^= z >> np.uint64(32)
        z *= _UNIT
        z ^= z >> np.uint64(29)
        lanes = z.view(np.uint16).reshape(-1, 4)
        r = logs[lanes[:, 0]] + logs[lanes[:, 1]]
        c = logs[lanes[:, 2]] + logs[lanes[:, 3]]
        b = ((z * _UNIT) >> np.uint64(48)).astype(np.float32) * np.float32(1 / (1 << 16))
        t = np.floor(log_weight / r + b)
        out[:, k] = np.minimum.reduceat(np.log(c) - r * (t - b + np.float32(1)), starts)
    return text[starts], out


def _signer(weights: Frequencies, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = mixed(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            for part in shingle_slices(batch):
                text, keys, n = shingles(part.column("text"))
                some, samples = weighted_samples(text, keys, n * weights.of(keys), bands * rows)
                codes = samples.view(np.uint32).reshape(len(some), bands, rows).astype(np.uint64)
                codes = mixed((codes * factors).sum(axis=2, dtype=np.uint64)).view(np.int64)
                lengths = np.zeros(part.num_rows, dtype=np.int32)
                lengths[some] = bands
                offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "key", "chars")), pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))],
                    ["doc_id", "key", "chars", "bands"],
                )
        trim_memory()

    return sign


def signatures(docs: DataFrame, weights: Frequencies, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, chars, bands, rep, first, copies``: one row per distinct text, staged. ``rep`` and ``first`` are
    the largest and least id of its rows; a text without words has no bands."""
    keyed = id_and_text(docs).select("doc_id", text_key(F.col("text")).alias("key"), F.length("text").alias("chars"), "text")
    signed = keyed.mapInArrow(_signer(weights, bands, rows), "doc_id long, key binary, chars int, bands array<long>")
    one = signed.groupBy("key", "chars", "bands").agg(F.max("doc_id").alias("rep"), F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    return stage(one, "signatures")


def bucket_members(signed: DataFrame) -> DataFrame:
    """``band, code, key, chars, members`` of the buckets with two texts or more, staged."""
    places = signed.select("key", "chars", F.posexplode("bands").alias("band", "code"))
    sizes = places.groupBy("band", "code").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    return stage(places.join(sizes, ["band", "code"]), "buckets")


def candidate_texts(docs: DataFrame, signed: DataFrame, members: DataFrame) -> DataFrame:
    """``key, text`` of every text in such a bucket, staged; taken from its row with the largest id."""
    wanted = signed.join(members.select("key").distinct(), "key", "left_semi").select(F.col("rep"), F.col("key").alias("wanted"))
    rows = id_and_text(docs).select("doc_id", text_key(F.col("text")).alias("key"), "text")
    met = rows.join(wanted, rows.doc_id.eqNullSafe(wanted.rep) & (rows.key == wanted.wanted)).select("key", "text")
    return stage(met.distinct(), "candidates")


def _blocks(texts: Column, chars: Column) -> Column:
    """How many blocks so many texts of so many characters in all make."""
    return F.greatest(F.ceil(texts / BLOCK), F.ceil(chars / BLOCK_CHARS), F.lit(1)).cast("long")


def star_groups(members: DataFrame) -> DataFrame:
    """``grp, asks, key``: each bucket's members ask its most central text, in blocks."""
    mass = members.groupBy("key").agg(F.sum("members").alias("mass"))
    leaders = members.join(mass, "key").groupBy("band", "code").agg(F.max(F.struct("mass", "key")).alias("lead"))
    pairs = members.join(leaders, ["band", "code"]).select("key", "chars", F.col("lead.key").alias("leader"))
    pairs = stage(pairs.filter("key <> leader").distinct(), "stars")
    blocks = pairs.groupBy("leader").agg(_blocks(F.count(F.lit(1)), F.sum("chars")).alias("blocks"))
    dealt = pairs.join(blocks, "leader").select("leader", "key", F.pmod(F.xxhash64("key"), F.col("blocks")).alias("block"))
    asks = dealt.select(F.xxhash64("leader", "block").alias("grp"), F.lit(True).alias("asks"), "key")
    asked = dealt.select(F.xxhash64("leader", "block").alias("grp"), F.lit(False).alias("asks"), F.col("leader").alias("key")).distinct()
    return asks.unionByName(asked)


def open_groups(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``grp, asks, key``: in buckets that span several classes, the members outside the largest class
    ask all members. Blocks of askers meet blocks of members."""
    named = members.join(classes.withColumnRenamed("node", "key"), "key", "left").select(
        "band", "code", "key", "chars", F.coalesce("component", "key").alias("component")
    )
    sizes = named.groupBy("band", "code", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    spans = sizes.groupBy("band", "code").agg(
        F.count(F.lit(1)).alias("classes"),
        F.sum("n").alias("n"),
        F.sum("chars").alias("chars"),
        F.max(F.struct("n", "component", "chars")).alias("main"),
    )
    spans = spans.filter("classes > 1").select(
        "band",
        "code",
        F.col("main.component").alias("main"),
        _blocks(F.col("n"), F.col("chars")).alias("blocks"),
        _blocks(F.col("n") - F.col("main.n"), F.col("chars") - F.col("main.chars")).alias("ask_blocks"),
    )
    open_ = stage(named.join(spans, ["band", "code"]), "open")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asks = open_.filter("component <> main").select(
        "band", "code", F.pmod(F.xxhash64("key"), F.col("ask_blocks")).alias("i"), every("blocks").alias("j"), F.lit(True).alias("asks"), "key"
    )
    asked = open_.select(
        "band", "code", every("ask_blocks").alias("i"), F.pmod(F.xxhash64("key"), F.col("blocks")).alias("j"), F.lit(False).alias("asks"), "key"
    )
    return asks.unionByName(asked).select(F.xxhash64("band", "code", "i", "j").alias("grp"), "asks", "key")


def similar(texts: pa.Array, weights: Frequencies, asks: np.ndarray, asked: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the rows ``asks`` and ``asked`` of ``texts`` have a weighted Jaccard similarity of at least
    ``threshold``, as a matrix.

    The n-th occurrence of a shingle in a text is an element of its own, so that the smaller of two
    counts is the number of elements in both."""
    text, keys, n = _shingles_of_many(texts)
    weight = weights.of(keys)
    total = np.bincount(text, weights=weight * n, minlength=len(texts))
    at = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    elements, index, times = np.unique(mixed(keys[at] + (nth.astype(np.uint64) << np.uint64(KEY_BITS))), return_inverse=True, return_counts=True)
    # an element that one text alone has is in no intersection
    shared = times[index] > 1
    column = np.cumsum(times > 1) - 1
    text, column, weight = text[at][shared], column[index[shared]], weight[at][shared]
    both = np.zeros((len(asks), len(asked)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    text, column, weight = text[order], column[order], weight[order]
    step = 4096
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        lo, hi = np.searchsorted(column, [first, first + step])
        has = np.zeros((len(texts), step), dtype=np.float32)
        has[text[lo:hi], column[lo:hi] - first] = np.sqrt(weight[lo:hi])
        both += has[asks] @ has[asked].T
    either = total[asks][:, None] + total[asked][None, :]
    # both / (either - both) >= threshold, with room for rounding
    return both * (1 + threshold) >= threshold * either * (1 - 1e-6) - 1e-9


def _shingles_of_many(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts, first = [], 0
    for part in shingle_slices(pa.RecordBatch.from_arrays([texts], ["text"])):
        text, keys, n = shingles(part.column("text"))
        parts.append((text + first, keys, n))
        first += part.num_rows
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _comparer(weights: Frequencies, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def links_of(group: pa.RecordBatch) -> tuple[list[bytes], list[bytes]]:
        flags = group.column("asks").to_numpy(zero_copy_only=False)
        asks, asked = np.flatnonzero(flags), np.flatnonzero(~flags)
        keys = group.column("key").to_pylist()
        linked = similar(group.column("text"), weights, asks, asked, threshold)
        # name each row by the least row it is linked to, directly or through others of the block
        name = np.arange(len(keys))
        a, b = np.nonzero(linked)
        a, b = asks[a], asked[b]
        while True:
            least = np.minimum(name[a], name[b])
            new = name.copy()
            np.minimum.at(new, a, least)
            np.minimum.at(new, b, least)
            new = new[new]
            if (new == name).all():
                break
            name = new
        moved = [i for i in range(len(keys)) if keys[i] != keys[name[i]]]
        return [keys[i] for i in moved], [keys[name[i]] for i in moved]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finished(whole: pa.Table) -> pa.RecordBatch:
            out: tuple[list[bytes], list[bytes]] = ([], [])
            grp = whole.column("grp").to_numpy()
            bounds = [*np.flatnonzero(np.diff(grp, prepend=grp[0] - 1 if len(grp) else 0)).tolist(), len(grp)]
            rows = whole.combine_chunks().to_batches()[0] if len(grp) else None
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                for column, more in zip(out, links_of(rows.slice(lo, hi - lo)), strict=True):
                    column.extend(more)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in out], ["a", "b"])

        # rows come sorted by group; the last group of a batch may go on in the next
        for batch in batches:
            grp = batch.column("grp").to_numpy()
            if not len(grp):
                continue
            cut = int(np.searchsorted(grp, grp[-1]))
            if cut or (held and held[0].column("grp")[0].as_py() != grp[0]):
                if cut == 0:
                    yield finished(pa.Table.from_batches(held))
                else:
                    yield finished(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield finished(pa.Table.from_batches(held))
        trim_memory()

    return compare


def verified_links(groups: DataFrame, texts: DataFrame, weights: Frequencies, threshold: float) -> DataFrame:
    """``a, b``: links among the texts of each group that connect what is similar enough, staged."""
    rows = groups.join(texts, "key").select("grp", "asks", "key", "text")
    dealt = rows.repartition(shuffle_partitions(groups.sparkSession), "grp").sortWithinPartitions("grp")
    return stage(dealt.mapInArrow(_comparer(weights, threshold), "a binary, b binary"), "links")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key, class_id, class_size``: the near-duplicate class of every distinct text."""
    weights = frequent_shingles(docs)
    signed = signatures(docs, weights, bands, rows)
    members = bucket_members(signed)
    texts = candidate_texts(docs, signed, members)
    stars = verified_links(star_groups(members), texts, weights, threshold)
    rest = verified_links(open_groups(members, connected_components(stars)), texts, weights, threshold)
    classes = connected_components(stars.unionByName(rest)).withColumnRenamed("node", "key")
    named = signed.join(classes, "key", "left").select("key", F.coalesce("component", "key").alias("component"), "first", "copies")
    named = stage(named, "named")
    sizes = named.groupBy("component").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_size"))
    return named.join(sizes, "component").select("key", "class_id", "class_size")


def near_dedup(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, class_id, class_size, kept`` for every row of ``docs``.

    A class holds equal texts and texts linked by a weighted Jaccard similarity of at least
    ``threshold`` over five-word shingles, directly or through others; it is named by its least id,
    and the row with that id stays. Null and empty texts are equal texts; texts without words are like
    their equals alone. Rows that repeat the least id are the same document and all say ``kept``; null
    ids stay only in a class without others. An empty table gives an empty result, other columns are
    ignored."""
    classes = stage(near_classes(docs, threshold, bands, rows), "classes")
    keyed = id_and_text(docs).select("doc_id", text_key(F.col("text")).alias("key"))
    return keyed.join(classes, "key").select(
        "doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def one_of_each_class(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each near-duplicate class."""
    classes = stage(near_classes(docs, threshold, bands, rows), "classes").select("key", "class_id")
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), text_key(text_or_empty(F.col("text"))).alias("key"))
    kept = keyed.join(classes, "key").filter(F.col("id").eqNullSafe(F.col("class_id")))
    # rows that repeat the id that stays; ids are rarely repeated, then nothing more is to do
    repeated = kept.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("class_id").alias("again"))
    repeated = stage(repeated, "repeated")
    if repeated.isEmpty():
        return kept.select("row.*")
    marked = kept.join(repeated, F.col("id").eqNullSafe(F.col("again")), "left_semi")
    alone = kept.join(repeated, F.col("id").eqNullSafe(F.col("again")), "left_anti")
    return alone.unionByName(marked.dropDuplicates(["id"])).select("row.*")
