"""Spelling variants: words one inserted, deleted or replaced letter apart, by PartEnum signatures.

1. ``vocabulary``: the words of whole texts and their counts, by one pre-aggregated groupBy.
2. A word's letter multiset is a binary vector with one place for the first, second, ... occurrence of
   each letter. An inserted or deleted letter changes one place, a replaced one two, so near words have
   vectors at Hamming distance two at most.
3. ``signatures`` (partition and enumerate): the places are dealt by letter into ``n1`` groups of ``n2``
   parts. Two vectors at distance ``k`` have a group in which at most ``k2 = (k + 1) / n1 - 1`` (rounded
   up) parts differ, so they agree on all parts of one of its subsets of ``n2 - k2`` parts. A subset
   with the vector's values there is a signature; near words share one, whatever their letters are.
4. Many words are made of the same letters. A signature therefore also holds half of the word: one
   changed letter leaves the first or the last half as it is. Words of ``2 m`` and ``2 m + 1`` letters
   have halves of ``m``; the former also stand for longer partners of words one shorter.
5. Signatures are joined by equality: a group of at most ``bound`` entries is compared member by member.
   Larger groups are never compared: the open half is halved again and each entry deals itself to the
   two finer signatures, until groups are small or one letter is open, where all members are near each
   other. Entries are counted before they are gathered, so no large group meets in one task.
6. Candidates are verified by edit distance. A pair counts in the first signature that it shares, so
   links need no dedup.

All steps are built-in functions over staged tables; a lost executor repeats one step at most.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalam.llm.tables import id_and_text, shuffle_partitions, stage

#: Letters of words as a class of a regex, least code points and occurrences of a word, and how much
#: more frequent a word's form has to be.
LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10

#: PartEnum: Hamming distance, groups of parts, and parts of each.
DISTANCE = 2
GROUPS, PARTS = 1, 3

#: Entries of a signature that are compared with each other.
BOUND = 32

#: Letters by how common they are, dealt to and fro over the parts; others follow by code point.
COMMON = "etaoinshrdlcumwfgypbvkjxqz"


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_every: int | None = None) -> DataFrame:
    """``word, n`` of every word of at least ``min_length`` code points and ``min_count`` occurrences.

    Words are maximal runs of ``LETTERS`` in whole texts, A-Z lower-cased. With ``drop_every``, an
    occurrence whose hash ``h``, the CRC-32 of ``<doc_id>:<word>``, is a multiple of it loses the code
    point ``h % length``."""
    # a run that is too short stays too short
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = id_and_text(docs).select("doc_id", F.explode(runs).alias("run")).select("doc_id", F.translate("run", upper, upper.lower()).alias("word"))
    if drop_every is not None:
        h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
        at = F.pmod(F.col("h"), F.length("word")).cast("int")
        cut = F.concat(F.substring(F.col("word"), F.lit(1), at), F.substring(F.col("word"), at + 2, F.length("word")))
        words = words.select("word", h.alias("h")).select(F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("word")).alias("word"))
    counted = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


def part_of(letter: str, parts: int) -> int:
    at = COMMON.find(letter)
    if at < 0:
        return ord(letter) % parts
    lap, place = divmod(at, parts)
    return place if lap % 2 == 0 else parts - 1 - place


def part_values(word: Column, parts: int) -> Column:
    """For each part, a hash of the word's letters in it, with repeats, in order. Characters that are in
    no part by themselves are in the first."""
    letters = COMMON + "".join(map(chr, range(0xC0, 0x100)))
    inside = ["".join(c for c in letters if part_of(c, parts) == p) for p in range(parts)]
    own = [F.translate(word, "".join(inside[1:]), "")] + [F.regexp_replace(word, f"[^{chosen}]+", "") for chosen in inside[1:]]
    return F.array(*(F.xxhash64(F.array_join(F.array_sort(F.split(x, "")), "")) for x in own))


def subsets(distance: int = DISTANCE, groups: int = GROUPS, parts: int = PARTS) -> list[tuple[int, ...]]:
    """The parts of each signature."""
    differing = -(-(distance + 1) // groups) - 1
    if differing >= parts:
        raise ValueError("more parts to a group are needed")
    return [tuple(g * parts + i for i in s) for g in range(groups) for s in itertools.combinations(range(parts), parts - differing)]


def signatures(words: DataFrame, groups: int = GROUPS, parts: int = PARTS) -> DataFrame:
    """Entries ``word, n, half, subset, parts, left, right, differ, key`` of every word: ``left`` letters at
    its start and ``right`` at its end are in the key, and pairs count only if their first ``differ``
    letters are not equal (-1: always)."""
    half = F.floor(F.length("word") / 2).cast("int")
    halves = F.when(F.length("word") % 2 == 0, F.array(half, half - 1)).otherwise(F.array(half))
    n_subsets = len(subsets(DISTANCE, groups, parts))
    placed = words.select("word", "n", F.explode(halves).alias("half"), part_values(F.col("word"), groups * parts).alias("parts"))
    each = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_subsets - 1))).alias("subset"))
    start = each.select("word", "n", "half", "subset", "parts", *(F.lit(x).alias(c) for c, x in (("left", 0), ("right", 0), ("differ", -1))), _values(groups, parts).alias("key"))
    return halved(start)


def _values(groups: int, parts: int) -> Column:
    """The word's values on the entry's subset of parts."""
    chosen = F.array(*(F.array(*map(F.lit, s)) for s in subsets(DISTANCE, groups, parts)))
    return F.xxhash64("half", "subset", F.transform(chosen[F.col("subset")], lambda i: F.col("parts")[i]))


def halved(entries: DataFrame) -> DataFrame:
    """Each entry twice: with the first half of its open letters in the key, and with the last."""
    gap = F.expr("2 * half - left - right")
    first = F.floor(gap / 2).cast("int")
    sides = entries.select("word", "n", "half", "subset", "parts", "left", "right", "differ", "key", gap.alias("gap"), first.alias("first"))
    both = sides.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    at_start = F.col("side") == 0
    more = F.when(at_start, F.col("first")).otherwise(F.col("gap") - F.col("first"))
    before, after = F.substring(F.col("word"), F.col("left") + 1, more), F.substring(F.col("word"), F.length("word") - F.col("right") - more + 1, more)
    return both.select(
        "word",
        "n",
        "half",
        "subset",
        "parts",
        F.when(at_start, F.col("left") + more).otherwise(F.col("left")).alias("left"),
        F.when(at_start, F.col("right")).otherwise(F.col("right") + more).alias("right"),
        F.when(at_start, F.col("differ")).otherwise(F.col("left") + F.col("first")).alias("differ"),
        F.xxhash64("key", "side", F.when(at_start, before).otherwise(after)).alias("key"),
    )


def _near_pairs(entries: DataFrame, groups: int, parts: int) -> DataFrame:
    """``word, n, near, near_n`` of every near pair, both ways, that counts in one of these groups of
    entries, which are small."""
    member = F.struct("word", "n", "parts", F.length("word").alias("length"))
    common = ["half", "subset", "differ"]
    met = entries.groupBy("key", *common).agg(F.collect_list(member).alias("members")).filter(F.size("members") > 1)
    pairs = met.select(*common, F.posexplode("members").alias("at", "a"), "members")

    def fits(other: Column) -> Column:
        # of two words the shorter has 2 m or 2 m + 1 letters; other pairs meet elsewhere
        shorter = F.least(F.col("a.length"), other.length)
        return (shorter <= 2 * F.col("half") + 1) & (F.abs(F.col("a.length") - other.length) <= 1)

    others = F.slice("members", F.col("at") + 2, F.size("members"))
    pairs = pairs.select(*common, "a", F.explode(F.filter(others, fits)).alias("b"))
    a, b = F.col("a.word"), F.col("b.word")
    first_half = (F.col("differ") < 0) | (F.substring(a, F.lit(1), F.col("differ")) != F.substring(b, F.lit(1), F.col("differ")))
    agree = [F.forall(F.array(*map(F.lit, s)), lambda i: F.col("a.parts")[i] == F.col("b.parts")[i]) for s in subsets(DISTANCE, groups, parts)]
    first_subset = ~F.lit(False)
    for i, same in enumerate(agree):
        first_subset &= (F.col("subset") <= i) | ~same
    near = pairs.filter(first_half & first_subset).filter(F.levenshtein(a, b, 1) == 1)
    both = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
    return near.select(both.alias("p")).select(
        F.col("p.x.word").alias("word"), F.col("p.x.n").alias("n"), F.col("p.y.word").alias("near"), F.col("p.y.n").alias("near_n")
    )


def near_words(words: DataFrame, groups: int = GROUPS, parts: int = PARTS, bound: int = BOUND) -> DataFrame:
    """``word, n, near, near_n`` for every ordered pair of near words of ``words (word, n)``, each once."""
    entries, found = stage(signatures(words, groups, parts), "signatures"), []
    while True:
        sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
        # where one letter is open, members differ there alone, and the alphabet bounds the group
        large = stage(sizes.filter(F.col("size") > bound).select("key"), "large")
        if large.isEmpty():
            found.append(_near_pairs(entries, groups, parts))
            break
        again = entries.join(large, "key", "left_semi")
        done = F.expr("2 * half - left - right <= 1")
        found.append(_near_pairs(entries.join(large, "key", "left_anti").unionByName(again.filter(done)), groups, parts))
        entries = stage(halved(again.filter(~done)), "signatures")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every word that has a form (``word, form``): the last of its forms' forms.

    Each round takes every word's target to that target's target, which doubles the steps taken. Counts
    grow ``TIMES``-fold with every form, so chains are short whatever the input."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = stage(step, "roots")
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def spelling_groups(words: DataFrame, times: int = TIMES, groups: int = GROUPS, parts: int = PARTS, bound: int = BOUND) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words (word, n)``, words being unique.

    A word's form is its most frequent near word (ties: least in code-point order) if that is at least
    ``times`` as frequent, else null; its root is what following forms ends at, itself without a form.
    ``n_near`` counts near words. An empty table gives an empty result, other columns are ignored."""
    words = stage(words.select("word", "n").repartition(shuffle_partitions(words.sparkSession), "word"), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near").alias("word")))
    near = near_words(words, groups, parts, bound).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.minus_n") >= times * F.col("n"), F.struct(F.col("best.word").alias("form"), (-F.col("best.minus_n")).alias("form_n"))).alias("best"),
    )
    judged = stage(judged.select("word", "n", "n_near", "best.form", "best.form_n"), "judged")
    last = roots(judged.filter("form IS NOT NULL"))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
