"""Quality rules: a threshold table compiled into one projection (built-in functions only).

``measures`` adds the figures of a text as columns, each from built-in string and array
expressions; ``compile_rules`` turns a threshold table into one boolean expression over them. There
is no shuffle, no join and no user function.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalam.llm.tables import held, text_or_empty

#: Fixed values of the word and symbol classes.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Function words of some languages; a prose text in one of them has some.
STOP_WORDS = (
    "the of and to in a is that for it with as on by was are this be at or from an not "
    "der die das und ist von den mit für auf ein eine einer im dem des nicht zu sich "
    "le la les de des et du un une est en que qui pour dans sur par au avec pas "
    "el los las y que del se una con por su al es no lo"
).split()

#: Codes of these languages, as they may stand in ``lang`` before a region or script.
STOP_LANGS = "en eng de deu ger fr fra fre es spa".split()


@dataclass(frozen=True)
class Threshold:
    """A text passes if ``low <= measure <= high`` (either may be open), or where ``only`` is false."""

    measure: str
    low: float | None = None
    high: float | None = None
    only: str | None = None


#: Base rules: a text that fails one of them is dropped.
BASE_RULES = (
    Threshold("n_words", low=50),
    Threshold("repeat_percent", high=50),
)

#: The method's own rules. Their limits are wide: they aim at symbol runs, shouting, lists of
#: fragments and texts that repeat their lines, and leave prose of any language alone: the stop words
#: judge only texts that are said to be in their languages and are not mostly in another script.
RULES = (
    Threshold("mean_word_length", low=2, high=15),
    Threshold("symbol_ratio", high=0.2),
    Threshold("stop_word_ratio", low=0.05, only="in_stop_lang"),
    Threshold("dup_line_ratio", high=0.5),
    Threshold("shout_ratio", high=0.5),
)


def in_stop_lang(rows: DataFrame) -> Column:
    """True where the stop words can judge a text: its ``lang`` is one of theirs and at least half of
    its letters are Latin. Without a known language nothing says so."""
    if "lang" not in rows.columns:
        return F.lit(False)
    code = F.lower(F.regexp_extract(F.col("lang").cast("string"), "^\\s*([A-Za-z]+)", 1))
    latin = 2 * matched_chars(r"\p{IsLatin}") >= matched_chars(r"\p{L}")
    return F.coalesce(code.isin(*STOP_LANGS) & latin, F.lit(False))


def matched_chars(kind: str) -> Column:
    """How many characters of ``text`` are of a class. What is left without them is measured: counting
    matches would make a string of each."""
    return F.length("text") - F.length(F.regexp_replace("text", f"{kind}++", ""))


def measures(rows: DataFrame) -> DataFrame:
    """The figures of every ``text``, beside ``row``; ``lang`` may stand there too. Words are maximal runs of other than ASCII white
    space. ``n_repeat_words`` counts the words that lie in a three-word window found twice or more
    in the text, the first one included; windows are compared by a 64-bit hash of their words."""
    body = F.btrim(F.col("text"), F.lit(SPACE_CHARS))
    split = rows.select(
        "row",
        held(F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE))).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "").alias("lines"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.floor((F.length("text") - F.length(F.replace("text", F.lit("!!"), F.lit("")))) / 2).cast("long").alias("n_shouts"),
        in_stop_lang(rows).alias("in_stop_lang"),
    )
    counted = split.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "CASE WHEN size(words) < 4 THEN CAST(array() AS array<bigint>) ELSE transform(sequence(0, size(words) - 3), "
            "i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))) END"
        ).alias("windows"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    ).drop("lines", "words")
    # equal windows are neighbours once sorted; positions are looked at only where there are some
    ordered = counted.withColumn(
        "windows",
        held(
            F.when(
                F.size(F.array_distinct("windows")) < F.size("windows"),
                F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            )
        ),
    )
    repeated = F.expr("filter(windows, (w, k) -> w.h <=> get(windows, k - 1).h OR w.h <=> get(windows, k + 1).h)")
    starts = ordered.withColumn("starts", held(F.sort_array(F.transform(repeated, lambda w: w.i))))
    covered = F.expr("aggregate(transform(starts, (s, k) -> least(3, coalesce(get(starts, k + 1) - s, 3))), 0L, (n, x) -> n + x)")
    return starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("windows", "starts")


def ratios(measured: DataFrame) -> DataFrame:
    def share(n: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.col(n) / F.col(of)).otherwise(F.lit(0.0))

    return measured.select(
        "*",
        (100 * share("n_repeat_words", "n_words")).alias("repeat_percent"),
        share("word_chars", "n_words").alias("mean_word_length"),
        share("n_symbols", "n_words").alias("symbol_ratio"),
        share("n_stop_words", "n_words").alias("stop_word_ratio"),
        share("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        share("n_shouts", "n_words").alias("shout_ratio"),
    )


def compile_rules(rules: Sequence[Threshold]) -> Column:
    """True where every rule of the table holds."""
    def where(rule: Threshold, test: Column) -> Column:
        return test if rule.only is None else test | ~F.col(rule.only)

    tests = [where(r, F.col(r.measure) >= r.low) for r in rules if r.low is not None]
    tests += [where(r, F.col(r.measure) <= r.high) for r in rules if r.high is not None]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def judged(rows: DataFrame, rules: Sequence[Threshold] = RULES) -> DataFrame:
    """``rows (row, text)`` with the figures of their texts, ``base_failed`` and ``kept``."""
    figures = ratios(measures(rows))
    # 100 * n_repeat_words > 50 * n_words in whole numbers, as the base rule is stated
    base = compile_rules([r for r in BASE_RULES if r.measure != "repeat_percent"]) & (
        100 * F.col("n_repeat_words") <= int(next(r.high for r in BASE_RULES if r.measure == "repeat_percent")) * F.col("n_words")
    )
    return figures.withColumns({"base_failed": ~base, "kept": base & compile_rules(rules)})


def lang_of(docs: DataFrame) -> list[Column]:
    return [F.col("lang").alias("lang")] if "lang" in docs.columns else []


def quality_rules(docs: DataFrame, rules: Sequence[Threshold] = RULES) -> DataFrame:
    """``doc_id``, the figures of its whole text, ``base_failed`` and ``kept`` for every row.

    A null or empty text has no words and fails the base rules. Repeated rows are judged alike,
    null ids stay, an empty table gives an empty result and other columns than ``lang``, which may be
    missing, are ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("row"), text_or_empty(F.col("text")).alias("text"), *lang_of(docs))
    return judged(rows, rules).select(
        F.col("row").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        *(F.col(r.measure) for r in rules),
    )


def with_quality(docs: DataFrame, rules: Sequence[Threshold] = RULES) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    rows = docs.select(F.struct("*").alias("row"), text_or_empty(F.col("text")).alias("text"), *lang_of(docs))
    return judged(rows, rules).filter("kept").select("row.*")
