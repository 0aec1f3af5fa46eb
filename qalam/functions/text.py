"""Column expressions for bilingual text cleaning.

Everything here returns a ``Column`` built from JVM-side functions, so it stays inside
whole-stage codegen. Patterns use ``\\x{...}`` escapes that Java regex and RE2 (the DuckDB
oracle) read the same way.

Characters are trimmed by ``btrim``, which looks at the ends of a text only. Where two-character markers
are at its ends, right-end trims use ``reverse`` + an anchored leading pattern: a ``...+$`` pattern is
tried at every start position and goes quadratic on long inner runs, the anchored form is linear.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
#   * whitespace = the characters Python's str.isspace() accepts:
#       U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A,
#       U+2028, U+2029, U+202F, U+205F, U+3000
#   * Arabic script block: U+0600-U+06FF
#   * Latin letters: A-Z, a-z
#   * Arabic diacritics: U+0610-U+061A, U+064B-U+065F, U+0670, U+06D6-U+06ED
#   * boundary markers: whitespace, "-", the two-character literal backslash + "n"
#   * direction tags: "<2ar> " before English sources, "<2en> " before Arabic sources
# ---------------------------------------------------------------------------------------------
WS_CLASS = (
    r"\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
OTHER_WS_CHARS = WS_CHARS.replace(" ", "")
DIACRITIC_CHARS = "".join(map(chr, [*range(0x610, 0x61B), *range(0x64B, 0x660), 0x670, *range(0x6D6, 0x6EE)]))
ARABIC_CLASS = r"[\x{0600}-\x{06FF}]"
LATIN_CLASS = r"[A-Za-z]"
DIACRITIC_CLASS = r"[\x{0610}-\x{061A}\x{064B}-\x{065F}\x{0670}\x{06D6}-\x{06ED}]"
TAG_TO_AR = "<2ar> "
TAG_TO_EN = "<2en> "
EN_TO_AR = "en_to_ar"
AR_TO_EN = "ar_to_en"

_NEWLINE = "\\n"
_LEAD_MARKERS = rf"^(?:[{WS_CLASS}\-]++|\\n)++"
# the same marker set read right-to-left: the literal "\n" appears as "n\"
_LEAD_MARKERS_REVERSED = rf"^(?:[{WS_CLASS}\-]++|n\\)++"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_text(c: Column | str) -> Column:
    """null -> "" and cast to string (the reference's ``fillna("").astype(str)``)."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def _trim_right(c: Column, reversed_leading_pattern: str) -> Column:
    return F.reverse(F.regexp_replace(F.reverse(c), reversed_leading_pattern, ""))


def strip_text(c: Column | str) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace (incl. U+001C-U+001F) at both ends."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def has_arabic(c: Column | str) -> Column:
    # a text of one byte per character has none, and need not be searched
    return (F.octet_length(_c(c)) != F.char_length(_c(c))) & _c(c).rlike(ARABIC_CLASS)


def has_latin(c: Column | str) -> Column:
    return _c(c).rlike(LATIN_CLASS)


def swap_mask(en: Column | str, ar: Column | str) -> Column:
    """Rows whose languages look exchanged (evaluated on null-filled text)."""
    e, a = fill_text(en), fill_text(ar)
    return has_arabic(e) & has_latin(a) & (~has_latin(e) | ~has_arabic(a))


def clean_boundaries(c: Column | str) -> Column:
    """Trim runs of whitespace, '-' and literal backslash-n from both ends (null -> "")."""
    t = F.btrim(fill_text(c), F.lit(WS_CHARS + "-"))
    rest = _trim_right(F.regexp_replace(t, _LEAD_MARKERS, ""), _LEAD_MARKERS_REVERSED)
    return F.when(t.startswith(_NEWLINE) | t.endswith(_NEWLINE), rest).otherwise(t)


def count_diacritics(c: Column | str) -> Column:
    return F.regexp_count(_c(c), F.lit(DIACRITIC_CLASS))


def strip_diacritics(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), DIACRITIC_CLASS, "")


def collapse_whitespace(c: Column | str) -> Column:
    """Every whitespace run -> one space, then strip (only a single space can remain at an end)."""
    return _single_spaces(F.translate(_c(c), OTHER_WS_CHARS, " " * len(OTHER_WS_CHARS)))


def strip_diacritics_and_collapse(c: Column | str) -> Column:
    """:func:`collapse_whitespace` of :func:`strip_diacritics`, in one pass over the text."""
    # characters without a counterpart are deleted
    return _single_spaces(F.translate(_c(c), OTHER_WS_CHARS + DIACRITIC_CHARS, " " * len(OTHER_WS_CHARS)))


def _single_spaces(c: Column) -> Column:
    """A text with no whitespace but spaces: every run of them -> one space, then strip."""
    return F.trim(F.regexp_replace(c, "  +", " "))


def word_count(c: Column | str) -> Column:
    """Python ``len(s.split())``: number of maximal non-whitespace runs ("" -> 0).

    Counted as the pieces, but for empty ones, of the text split at spaces, which all other whitespace is
    turned into: a split at one plain character needs no regular expression."""
    spaced = F.translate(fill_text(c), OTHER_WS_CHARS, " " * len(OTHER_WS_CHARS))
    return F.size(F.array_remove(F.split(spaced, " "), "")).cast("long")


def char_count(c: Column | str) -> Column:
    """Code-point length of the null-filled text (Python ``len``)."""
    return F.char_length(fill_text(c)).cast("long")


def tag_source(c: Column | str, direction: str) -> Column:
    tag = TAG_TO_AR if direction == EN_TO_AR else TAG_TO_EN
    return F.concat(F.lit(tag), _c(c))


def detect_direction(text: Column | str, direction: Column | str | None = None) -> Column:
    """'auto' (or null) -> ar_to_en when the stripped text holds an Arabic character, else en_to_ar.

    An explicit en_to_ar / ar_to_en passes through; any other value raises at run time.
    Blank text gives "".
    """
    t = strip_text(fill_text(text))
    auto = F.when(has_arabic(t), F.lit(AR_TO_EN)).otherwise(F.lit(EN_TO_AR))
    if direction is None or (isinstance(direction, str) and direction == "auto"):
        chosen = auto
    elif isinstance(direction, str):
        if direction not in (EN_TO_AR, AR_TO_EN):
            raise ValueError("direction must be one of: auto, en_to_ar, ar_to_en")
        chosen = F.lit(direction)
    else:
        d = direction
        chosen = (
            F.when(d.isNull() | (d == "auto"), auto)
            .when(d.isin(EN_TO_AR, AR_TO_EN), d)
            .otherwise(F.raise_error(F.lit("direction must be one of: auto, en_to_ar, ar_to_en")))
        )
    return F.when(t == "", F.lit("")).otherwise(chosen)


def tagged_source(text: Column | str, direction: Column) -> Column:
    """Source text with the direction tag for ``detect_direction`` output ("" stays "")."""
    t = strip_text(fill_text(text))
    return (
        F.when(direction == EN_TO_AR, F.concat(F.lit(TAG_TO_AR), t))
        .when(direction == AR_TO_EN, F.concat(F.lit(TAG_TO_EN), t))
        .otherwise(F.lit(""))
    )
