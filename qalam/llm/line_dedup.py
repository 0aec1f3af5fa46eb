"""Cross-site boilerplate lines, by how many distinct sites a line is on.

Each document's lines are reduced to 64-bit hashes once and staged. A line that occurs fewer times
than the threshold is on too few sites; the others get a HyperLogLog sketch of their sites, merged by
aggregation. Where the estimate is too close to the threshold to be trusted, the distinct sites are
counted exactly. Lines over the threshold are boilerplate and leave every document.

Counts and sketches combine in the map tasks, so a line on a third of all pages reaches the shuffle
once per task; the documents' texts are shuffled once, to meet the lines they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalam.llm.tables import stage, text_or_empty

#: Distinct sites that make a line boilerplate, and words that a line has at least to be judged. At 1
#: every line that isn't blank is judged, in scripts without spaces too.
MIN_SITES = 5
MIN_WORDS = 1

#: Share of its characters that a document may lose; one that would lose more stays whole. At 1 every
#: document loses its boilerplate lines, however much of it they are.
MAX_SHARE = 1.0

#: Sketches of 2**12 registers; estimates within this share of the threshold, or within one site of
#: it, are counted exactly: over three standard errors.
SKETCH_LOG_K = 12
NEAR = 0.06

SPACE_CHARS = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """Lines are equal if they are identical without the white space around them."""
    return F.xxhash64(F.btrim(line, F.lit(SPACE_CHARS)))


def judged(line: Column, min_words: int) -> Column:
    """True for lines of at least ``min_words`` words."""
    return line.rlike(rf"^(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){{{min_words - 1}}}[\x20\x09-\x0D]*[^\x20\x09-\x0D]")


def line_keys(lines: Column, min_words: int) -> Column:
    """The keys of the judged lines, each once."""
    return F.array_distinct(F.transform(F.filter(lines, lambda x: judged(x, min_words)), line_key))


def line_table(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, site, line``: each judged line of a document once, staged."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("site"),
        F.split(text_or_empty(F.col("text")), "\n").alias("lines"),
    )
    return stage(rows.select("doc_id", "site", F.explode(line_keys(F.col("lines"), min_words)).alias("line")), "lines")


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES, near: float = NEAR, log_k: int = SKETCH_LOG_K) -> DataFrame:
    """``line`` of every line on at least ``min_sites`` distinct sites."""
    frequent = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_sites).select("line")
    places = lines.select("line", "site").join(frequent, "line", "left_semi")
    spread = places.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_k))).alias("sites"))
    spread = stage(spread, "spread")
    margin = max(1.0, near * min_sites)
    sure = spread.filter(F.col("sites") > min_sites + margin).select("line")
    close = spread.filter(F.col("sites").between(min_sites - margin, min_sites + margin)).select("line")
    counted = places.join(close, "line", "left_semi").groupBy("line", "site").agg(F.lit(1).alias("one")).groupBy("line").agg(F.sum("one").alias("n"))
    return sure.unionByName(counted.filter(F.col("n") >= min_sites).select("line"))


def with_clean_text(
    docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, max_share: float = MAX_SHARE, evidence: DataFrame | None = None
) -> DataFrame:
    """``row`` (all of ``docs``' columns), ``clean``, ``n_lines``, ``n_boilerplate`` and ``n_removed``.

    With ``evidence``, the sites of these documents alone make a line boilerplate."""
    lines = line_table(docs, min_words)
    seen = lines if evidence is None else line_table(evidence, min_words)
    common = stage(boilerplate_lines(seen, min_sites), "boilerplate")
    lost = lines.join(common, "line", "left_semi").groupBy("doc_id").agg(F.collect_set("line").alias("lost"))
    lost = lost.select(F.col("doc_id").alias("of"), "lost")
    # null ids have lines too
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), text_or_empty(F.col("text")).alias("text"))
    met = rows.join(lost, F.col("id").eqNullSafe(F.col("of")), "left").select("row", "text", F.split("text", "\n").alias("lines"), "lost")

    def common_line(line: Column) -> Column:
        return F.array_contains("lost", line_key(line)) & judged(line, min_words)

    kept = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~common_line(x)))
    split = met.select("row", "text", "lines", kept.alias("kept"))
    boilerplate = F.size("lines") - F.size("kept")
    gone = F.length(F.array_join("lines", "")) - F.length(F.array_join("kept", ""))
    page = gone <= F.lit(max_share) * F.length(F.array_join("lines", ""))
    return split.select(
        "row",
        F.when((boilerplate > 0) & page, F.array_join("kept", "\n")).otherwise(F.col("text")).alias("clean"),
        F.size("lines").cast("long").alias("n_lines"),
        boilerplate.cast("long").alias("n_boilerplate"),
        F.when(page, boilerplate).otherwise(F.lit(0)).cast("long").alias("n_removed"),
    )


def line_dedup(
    docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, max_share: float = MAX_SHARE
) -> DataFrame:
    """``doc_id, n_lines, n_boilerplate, n_removed, text`` for every row, with the text that is left.

    Sites are the values of ``source``, null being one of them. A null or empty text is one empty line.
    Repeated rows come back alike, null ids stay, an empty table gives an empty result, other columns
    are ignored."""
    only = docs.select("doc_id", "text", "source")
    return with_clean_text(only, min_sites, min_words, max_share).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_boilerplate", "n_removed", F.col("clean").alias("text")
    )


def without_boilerplate(
    docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, max_share: float = MAX_SHARE, evidence: DataFrame | None = None
) -> DataFrame:
    """``docs`` with ``text``, and ``n_chars`` where there is one, as they are without such lines.

    Where ``docs`` hold near copies of a text, the lines that these share are not boilerplate. With one
    document of each class of near copies as ``evidence``, they stay."""
    rows = with_clean_text(docs, min_sites, min_words, max_share, evidence)
    changed = F.col("n_removed") > 0
    row = F.col("row").withField("text", F.when(changed, F.col("clean")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(changed, F.length("clean").cast(kind)).otherwise(F.col("row.n_chars")))
    return rows.select(row.alias("row")).select("row.*")
