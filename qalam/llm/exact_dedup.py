"""Exact deduplication over an extendible-hash index kept on shared files (built-in functions only).

1. ``distinct_texts``: one entry per distinct text, compared byte by byte (the text itself is a
   grouping key beside its 64-bit hash). Copies combine in the map tasks, so a text that fills a
   third of the table reaches the shuffle once per task.
2. ``directory``: the state an extendible-hash directory reaches by doubling. A bucket is a prefix
   of the hash; one that holds more than ``capacity`` entries is split by the next bit, and the
   directory doubles until its depth covers the deepest bucket.
3. ``build_index``: every bucket, a contiguous range of keys, goes to one owner task, which chains
   the entries that share a hash but not their bytes. The index is written under the shared
   checkpoint folder and read from there.
4. ``lookup``: each row finds its entry by hash; where a chain has several entries, by its bytes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qalam.llm.tables import id_and_text, shuffle_partitions, stage

#: Deepest split of a bucket; entries that agree in so many bits stay in one bucket and are chained.
MAX_DEPTH = 20

#: Buckets that an owner task gets on average when no capacity is given.
BUCKETS_PER_TASK = 8


def hash_key(text: Column, key_bits: int = 64) -> Column:
    """The leading ``key_bits`` of the text's 64-bit hash (fewer bits: collisions, for tests)."""
    key = F.xxhash64(text)
    return key if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)


def distinct_texts(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """``key, text_sha256, keep_id, group_size``: one row per distinct text, staged."""
    rows = id_and_text(docs).select("doc_id", "text", hash_key(F.col("text"), key_bits).alias("key"))
    entries = rows.groupBy("key", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return stage(entries.select("key", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size"), "texts")


def directory(entries: DataFrame, capacity: int | None = None) -> DataFrame:
    """``cell, bucket, depth``: the bucket of every directory cell.

    The table has at most ``2**MAX_DEPTH`` rows whatever the input: cells are counted at one depth
    that surely covers the doubling, and a cell's bucket is its shortest prefix within capacity."""
    spark = entries.sparkSession
    total = entries.count()
    if capacity is None:
        capacity = max(1, math.ceil(total / (BUCKETS_PER_TASK * shuffle_partitions(spark))))
    top = min(MAX_DEPTH, max(1, math.ceil(math.log2(max(2, total / capacity))) + 3))
    cells = entries.groupBy(cell_of(F.col("key"), top).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    prefixes = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(top))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(cell, {top} - depth)")
    )
    fits = (
        prefixes.groupBy("depth", "prefix")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("n") <= capacity) | (F.col("depth") == top))
        .drop("n")
    )
    shortest = prefixes.join(fits, ["depth", "prefix"]).groupBy("cell").agg(F.min(F.struct("depth", "prefix")).alias("b"))
    # a bucket's number is the left end of its key range at the directory's depth
    return shortest.select(
        "cell",
        F.expr(f"shiftleft(b.prefix, {top} - b.depth)").alias("bucket"),
        F.col("b.depth").alias("depth"),
        F.lit(top).alias("top"),
    )


def cell_of(key: Column, top: int) -> Column:
    return F.shiftrightunsigned(key, 64 - top).cast("long")


def build_index(entries: DataFrame, capacity: int | None = None) -> DataFrame:
    """``bucket, depth, key, chain, chain_length, sha, keep_id, group_size``, staged and sorted by key."""
    spark = entries.sparkSession
    slots = stage(directory(entries, capacity), "directory")
    first = slots.first()
    top = first["top"] if first else 1
    placed = entries.withColumn("cell", cell_of(F.col("key"), top)).join(slots.drop("top"), "cell").drop("cell")
    owned = placed.repartition(shuffle_partitions(spark), "bucket")
    same_key = Window.partitionBy("bucket", "key")
    chained = owned.select(
        "bucket",
        "depth",
        "key",
        F.row_number().over(same_key.orderBy(F.col("keep_id").desc_nulls_last(), "sha")).alias("chain"),
        F.count(F.lit(1)).over(same_key).alias("chain_length"),
        "sha",
        "keep_id",
        "group_size",
    )
    return stage(chained.sortWithinPartitions("bucket", "key", "chain"), "index")


def lookup(docs: DataFrame, index: DataFrame, key_bits: int = 64) -> DataFrame:
    """Every row of ``docs`` with the entry of its text."""
    rows = id_and_text(docs).select("doc_id", "text", hash_key(F.col("text"), key_bits).alias("key"))
    found = ["doc_id", "keep_id", "group_size", "sha"]
    alone = index.filter("chain_length = 1").select("key", "keep_id", "group_size", "sha")
    out = rows.select("doc_id", "key").join(alone, "key").select(*found)
    chains = index.filter("chain_length > 1").select("key", "chain", "keep_id", "group_size", "sha")
    if chains.isEmpty():
        return out
    # the bytes of each chained entry, taken from a row that holds its text
    keys = chains.select("key").distinct()
    chained = rows.join(keys, "key", "left_semi")
    bytes_of = chained.groupBy("key", "text").agg(F.max("doc_id").alias("keep_id")).withColumn("sha", F.unhex(F.sha2("text", 256)))
    entry = bytes_of.select("key", "text", "sha").join(chains.select("key", "sha", "keep_id", "group_size"), ["key", "sha"])
    return out.unionByName(chained.join(entry, ["key", "text"]).select(*found))


def exact_dedup(docs: DataFrame, capacity: int | None = None, key_bits: int = 64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when identical; a null text is an empty one, and all empty texts are equal. Of
    equal texts the row with the largest ``doc_id`` stays. Rows that repeat that ``doc_id`` are the
    same document and all say ``kept``; null ids stay only where a text has no other. An empty
    table gives an empty result, other columns are ignored."""
    index = build_index(distinct_texts(docs, key_bits), capacity)
    return lookup(docs, index, key_bits).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
