"""License scan: ordered signature rules gated by keywords (built-in functions only).

A text is reduced to its lower-cased words, one space between them. Each rule has a keyword, a
regex over those words, a label and a priority (1: licence statements and identifiers, 2: licence
names, 3: generic remarks). A rule's regex runs only on texts that hold its keyword. The places of
all rules are then walked in order of start: a place inside one of equal or better priority is
suppressed, of equal places the better rule stays. All of it is one projection of array functions;
nothing is shuffled or joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalam.llm.tables import held, id_and_text

#: The characters between words, and the base phrases with their labels.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

STATEMENT, NAME, REMARK = 1, 2, 3

#: A place that is left after suppression, and how many of them are gathered at a time.
_LEFT = "struct<s: int, e: int, priority: int, label: string>"
CHUNK = 512

#: How sure a place of each priority makes us.
CONFIDENCE = {STATEMENT: 1.0, NAME: 0.7, REMARK: 0.4}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int


_V = r"(?: version| ver| v)?"

#: (label, keyword, regex of the licence's name, words of its SPDX identifier or None). The keyword is in
#: all that the regex matches; a name without it has a row of its own.
LICENCES = (
    ("mit", "mit", r"mit(?: expat)? licen[cs]e", "mit"),
    ("mit", "expat", r"expat licen[cs]e", None),
    ("mit-0", "no attribution", r"mit no attribution(?: licen[cs]e)?", "mit 0"),
    ("x11", "x11", r"x11 licen[cs]e|mit x11 licen[cs]e", "x11"),
    ("isc", "isc", r"isc licen[cs]e", "isc"),
    ("apache-1.0", "apache", rf"apache(?: software)? licen[cs]e{_V} 1 0", "apache 1 0"),
    ("apache-1.1", "apache", rf"apache(?: software)? licen[cs]e{_V} 1 1", "apache 1 1"),
    ("apache-2.0", "apache", rf"apache(?: software)? licen[cs]e{_V} 2(?: 0)?", "apache 2 0"),
    ("bsd-1-clause", "bsd", r"(?:bsd 1|1 clause bsd|one clause bsd)(?: clause)?(?: licen[cs]e)?", "bsd 1 clause"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[cs]e)?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)(?: licen[cs]e)?", "bsd 4 clause"),
    ("0bsd", "bsd", r"(?:0 clause bsd|zero clause bsd|0bsd)(?: licen[cs]e)?", "0bsd"),
    ("0bsd", "free public", r"free public licen[cs]e", None),
    ("gpl-1.0", "general public", rf"(?:gnu )?general public licen[cs]e{_V} 1(?: 0)?", "gpl 1 0"),
    ("gpl-2.0", "general public", rf"(?:gnu )?general public licen[cs]e{_V} 2(?: 0)?", "gpl 2 0"),
    ("gpl-3.0", "general public", rf"(?:gnu )?general public licen[cs]e{_V} 3(?: 0)?", "gpl 3 0"),
    ("gpl-2.0", "gpl", rf"(?:gnu )?gpl{_V} ?2(?: 0)?", "gpl 2 0 only"),
    ("gpl-3.0", "gpl", rf"(?:gnu )?gpl{_V} ?3(?: 0)?", "gpl 3 0 only"),
    ("gpl-2.0-or-later", "later", rf"(?:gnu )?(?:general public licen[cs]e|gpl){_V} ?2(?: 0)? or(?: any)? later", "gpl 2 0 or later"),
    ("gpl-3.0-or-later", "later", rf"(?:gnu )?(?:general public licen[cs]e|gpl){_V} ?3(?: 0)? or(?: any)? later", "gpl 3 0 or later"),
    ("lgpl-2.0", "library general", rf"(?:gnu )?library general public licen[cs]e(?:{_V} 2(?: 0)?)?", "lgpl 2 0"),
    ("lgpl-2.1", "lesser general", rf"(?:gnu )?lesser general public licen[cs]e{_V} 2(?: 1)?", "lgpl 2 1"),
    ("lgpl-3.0", "lesser general", rf"(?:gnu )?lesser general public licen[cs]e{_V} 3(?: 0)?", "lgpl 3 0"),
    ("lgpl-2.1", "lgpl", rf"(?:gnu )?lgpl{_V} ?2(?: 1)?", "lgpl 2 1 only"),
    ("lgpl-3.0", "lgpl", rf"(?:gnu )?lgpl{_V} ?3(?: 0)?", "lgpl 3 0 only"),
    ("agpl-3.0", "affero", rf"(?:gnu )?affero general public licen[cs]e(?:{_V} 3(?: 0)?)?", "agpl 3 0"),
    ("agpl-3.0", "agpl", rf"(?:gnu )?agpl{_V} ?3(?: 0)?", "agpl 3 0 only"),
    ("gfdl-1.1", "documentation", rf"(?:gnu )?free documentation licen[cs]e{_V} 1 1", "gfdl 1 1"),
    ("gfdl-1.2", "documentation", rf"(?:gnu )?free documentation licen[cs]e{_V} 1 2", "gfdl 1 2"),
    ("gfdl-1.3", "documentation", rf"(?:gnu )?free documentation licen[cs]e{_V} 1 3", "gfdl 1 3"),
    ("mpl-1.0", "mozilla", rf"mozilla public licen[cs]e{_V} 1 0", "mpl 1 0"),
    ("mpl-1.1", "mozilla", rf"mozilla public licen[cs]e{_V} 1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", rf"mozilla public licen[cs]e{_V} 2(?: 0)?", "mpl 2 0"),
    ("epl-1.0", "eclipse", rf"eclipse public licen[cs]e{_V} 1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse", rf"eclipse public licen[cs]e{_V} 2(?: 0)?", "epl 2 0"),
    ("edl-1.0", "eclipse", rf"eclipse distribution licen[cs]e(?:{_V} 1(?: 0)?)?", None),
    ("cpl-1.0", "common public", rf"common public licen[cs]e(?:{_V} 1(?: 0)?)?", "cpl 1 0"),
    ("cddl-1.0", "development and distribution", rf"common development and distribution licen[cs]e(?:{_V} 1 0)?", "cddl 1 0"),
    ("cddl-1.1", "development and distribution", rf"common development and distribution licen[cs]e{_V} 1 1", "cddl 1 1"),
    ("eupl-1.1", "european union", rf"european union public licen[cs]e{_V} 1 1", "eupl 1 1"),
    ("eupl-1.2", "european union", rf"european union public licen[cs]e{_V} 1 2", "eupl 1 2"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e", "ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e", "ms rl"),
    ("artistic-1.0", "artistic", rf"(?:perl )?artistic licen[cs]e(?:{_V} 1(?: 0)?)?", "artistic 1 0"),
    ("artistic-2.0", "artistic", rf"artistic licen[cs]e{_V} 2(?: 0)?", "artistic 2 0"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", "zlib"),
    ("libpng", "libpng", r"libpng licen[cs]e", "libpng"),
    ("bsl-1.0", "boost", rf"boost software licen[cs]e(?:{_V} 1(?: 0)?)?", "bsl 1 0"),
    ("busl-1.1", "business source", rf"business source licen[cs]e(?:{_V} 1 1)?", "busl 1 1"),
    ("sspl-1.0", "server side", rf"server side public licen[cs]e(?:{_V} 1)?", "sspl 1 0"),
    ("elastic-2.0", "elastic", rf"elastic licen[cs]e(?:{_V} 2(?: 0)?)?", "elastic 2 0"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", "unlicense"),
    ("wtfpl", "what the", r"do what the \S+ you want to public licen[cs]e", None),
    ("wtfpl", "wtfpl", r"wtfpl", "wtfpl"),
    ("psf-2.0", "python", rf"python software foundation licen[cs]e(?:{_V} 2)?", "psf 2 0"),
    ("psf-2.0", "psf", r"psf licen[cs]e", None),
    ("php-3.01", "php", rf"php licen[cs]e(?:{_V} 3 0?1)?", "php 3 01"),
    ("ruby", "ruby", r"ruby licen[cs]e", "ruby"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", "postgresql"),
    ("openssl", "openssl", r"openssl licen[cs]e", "openssl"),
    ("curl", "curl", r"curl licen[cs]e", "curl"),
    ("ofl-1.1", "open font", rf"(?:sil )?open font licen[cs]e(?:{_V} 1 1)?", "ofl 1 1"),
    ("osl-3.0", "open software", rf"open software licen[cs]e(?:{_V} 3(?: 0)?)?", "osl 3 0"),
    ("afl-3.0", "academic free", rf"academic free licen[cs]e(?:{_V} 3(?: 0)?)?", "afl 3 0"),
    ("ecl-2.0", "educational community", rf"educational community licen[cs]e(?:{_V} 2(?: 0)?)?", "ecl 2 0"),
    ("ncsa", "illinois", r"university of illinois ncsa(?: open source)? licen[cs]e", "ncsa"),
    ("qpl-1.0", "q public", rf"q public licen[cs]e(?:{_V} 1 0)?", "qpl 1 0"),
    ("lppl-1.3c", "latex", rf"latex project public licen[cs]e(?:{_V} 1 3c?)?", "lppl 1 3c"),
    ("odbl-1.0", "database", rf"open (?:data commons open )?database licen[cs]e(?:{_V} 1 0)?", "odbl 1 0"),
    ("odc-by-1.0", "data commons", rf"open data commons attribution licen[cs]e(?:{_V} 1 0)?", "odc by 1 0"),
    ("pddl-1.0", "public domain dedication", rf"public domain dedication and licen[cs]e(?:{_V} 1 0)?", "pddl 1 0"),
    ("ogl-uk-3.0", "open government", rf"open government licen[cs]e(?:{_V} 3(?: 0)?)?", "ogl uk 3 0"),
    ("vim", "vim", r"vim licen[cs]e", "vim"),
    ("beerware", "beer", r"beer ?ware(?: licen[cs]e)?", "beerware"),
    ("openrail", "rail", r"(?:creativeml )?open ?rail(?: m)?(?: licen[cs]e)?", None),
    ("openrail", "responsible ai", r"responsible ai licen[cs]e", None),
    ("llama", "llama", r"llama (?:[0-9] )?community licen[cs]e(?: agreement)?", None),
)

#: Creative Commons: the words of each variant in short and in long form, for each version.
CC_VARIANTS = (
    ("by", "by", "attribution"),
    ("by-sa", "by sa", "attribution share ?alike"),
    ("by-nd", "by nd", "attribution no ?deriv(?:ative)?s?"),
    ("by-nc", "by nc", "attribution non ?commercial"),
    ("by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?"),
)
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

#: Remarks that name no licence.
REMARKS = (
    ("copyright", "copyright", r"copyright(?: c)? (?:19|20)\d\d(?: (?:19|20)\d\d)*"),
    ("reserved", "rights reserved", r"(?:all|some|no) rights reserved"),
    ("public-domain", "public domain", r"(?:dedicated to|released (?:in)?to|placed in|in) the public domain"),
    ("proprietary", "proprietary", r"proprietary and confidential|proprietary licen[cs]e"),
    ("no-commercial-use", "commercial", r"(?:for )?non ?commercial use only|not for commercial use"),
    ("free-license", "licen", r"(?:free|open source|permissive|copyleft) (?:software )?licen[cs]es?"),
    ("unknown-license", "licen", r"(?:licen[cs]ed|released|distributed) under(?: \S+){1,6} licen[cs]es?"),
)

_NOTICE = (
    r"(?:licen[cs]ed|released|distributed|published|provided|made available|available|redistributed|shared|covered) "
    r"(?:under|by|through)(?: the)?(?: terms(?: and conditions)? of(?: the)?)?"
)


def _name_rules(label: str, keyword: str, name: str, spdx: str | None) -> list[Rule]:
    """A licence's rules: a notice, an identifier, a link text, and the bare name."""
    rules = [
        Rule(label, keyword, rf"{_NOTICE} (?:{name})", STATEMENT),
        Rule(label, keyword, rf"(?:subject to|according to|see|governed by|terms of)(?: the)? (?:{name})", STATEMENT),
    ]
    if spdx:
        rules.append(Rule(label, spdx.split(" ")[0], rf"spdx licen[cs]e identifier {spdx}", STATEMENT))
        rules.append(Rule(label, spdx.split(" ")[0], rf"opensource org licen[cs]es? {spdx}", STATEMENT))
    return [*rules, Rule(label, keyword, name, NAME)]


def signature_rules() -> tuple[Rule, ...]:
    rules = [r for row in LICENCES for r in _name_rules(*row)]
    for slug, short, long in CC_VARIANTS:
        for version in CC_VERSIONS:
            words = version.replace(".", " ")
            in_full = rf"creative commons {long} {words}(?: international| unported| generic)?(?: licen[cs]e)?"
            name = rf"cc {short} {words}|{in_full}"
            label = f"cc-{slug}-{version}"
            rules.append(Rule(label, "cc by", rf"{_NOTICE} (?:a )?cc {short} {words}", STATEMENT))
            rules.append(Rule(label, "creative commons", rf"{_NOTICE} (?:a )?{in_full}", STATEMENT))
            rules.append(Rule(label, "creativecommons", rf"creativecommons org licen[cs]es {short} {words}", STATEMENT))
            rules.append(Rule(label, words, name, NAME))
        rules.append(Rule(f"cc-{slug}", "creative commons", rf"creative commons {long}", REMARK))
    rules.append(Rule("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", NAME))
    rules += [Rule(label, keyword, pattern, REMARK) for label, keyword, pattern in REMARKS]
    return tuple(rules)


#: One of these is in every text on which a rule can match (the same word beside a licence's name).
GATE = ("licen", "cc by", "cc0", "commons", "rights reserved", "copyright", "public domain", "proprietary", "commercial use",
        "gpl", "bsd", "beer", "rail", "wtfpl", "no attribution")


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """The words of a text in order, A-Z lower-cased, with one space before, between and after them."""
    lower = F.translate(text, UPPER, UPPER.lower())
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(lower, NO_WORD, " ")), F.lit(" "))


_PLACES = "array<struct<s: int, e: int>>"


def _places(words: str, pattern: str) -> str:
    """SQL array of the (first word, word after the last) of a regex's matches in ``words``.

    Matches are marked by characters that no word has, then the words are counted once: linear in the
    text, and a text without a match isn't split at all."""
    words_with_marks = "transform(split(btrim(t), ' ', -1), (w, i) -> struct(i AS i, startswith(w, '\\u0001') AS a, endswith(w, '\\u0002') AS z))"
    starts, ends = (f"transform(filter(m, x -> x.{side}), x -> x.i)" for side in "az")
    # an expression is bound by transform over an array of it, or it would be computed for each use
    pairs = f"transform(array(filter({words_with_marks}, x -> x.a OR x.z)), m -> zip_with({starts}, {ends}, (s, e) -> struct(s AS s, e + 1 AS e)))[0]"
    marked = f"regexp_replace({words}, {pattern}, '\\u0001$1\\u0002')"
    return f"transform(array({marked}), t -> IF(contains(t, '\\u0001'), {pairs}, CAST(array() AS {_PLACES})))[0]"


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bounded(pattern: str) -> str:
    """Whole words only; the spaces around a match are not part of it, so neighbours can share one."""
    return rf"(?<= )({pattern})(?= )"


def _rule_array(rules: Sequence[Rule]) -> str:
    rows = (
        f"struct({_literal(r.label)} AS label, {_literal(r.keyword)} AS keyword, {_literal(_bounded(r.pattern))} AS pattern, "
        f"{r.priority} AS priority, {i} AS rank)"
        for i, r in enumerate(rules)
    )
    return f"array({', '.join(rows)})"


def license_scan(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """``doc_id``, the word and base-phrase figures of its whole text, its labels and a score.

    ``detections`` has the places that are left after suppression as (label, priority, first word,
    words). A null or empty text has no words, no places and score 0. Repeated rows come back alike,
    null ids stay, an empty table gives an empty result, other columns are ignored."""
    rules = signature_rules() if rules is None else tuple(rules)
    rows = id_and_text(docs).select("doc_id", held(words_of(F.col("text"))).alias("words"))
    # the text's words are kept only where some rule or phrase may match
    gates = " OR ".join(f"contains(words, {_literal(g)})" for g in GATE)
    counted = rows.select(
        "doc_id",
        F.when(F.length("words") <= 2, F.lit(0)).otherwise(F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) - 1)
        .cast("long")
        .alias("n_words"),
        held(F.when(F.expr(gates), F.col("words"))).alias("words"),
    )
    base = ", ".join(
        f"transform({_places('words', _literal(_bounded(phrase)))}, p -> struct(p.s AS s, {_literal(label)} AS label))"
        for phrase, label in BASE_PHRASES
    )
    found = counted.select(
        "*",
        F.when(F.col("words").isNotNull(), F.expr(f"array_sort(concat({base}))")).alias("base"),
        F.when(F.col("words").isNotNull(), F.expr(f"filter({_rule_array(rules)}, r -> contains(words, r.keyword))")).alias("open"),
    ).withColumn(
        "hits",
        held(
            F.when(
                F.size("open") > 0,
                F.expr(
                    # starts ascend, of equal starts the longest comes first, then the better rule
                    f"array_sort(flatten(transform(open, r -> transform({_places('words', 'r.pattern')}, "
                    "p -> struct(p.s AS s, -p.e AS minus_e, r.priority AS priority, r.rank AS rank, r.label AS label)))))"
                ),
            )
        ),
    )
    inside = "CASE h.priority WHEN 1 THEN a.e1 WHEN 2 THEN a.e2 ELSE a.e3 END >= -h.minus_e"
    place = "struct(h.s AS s, -h.minus_e AS e, h.priority AS priority, h.label AS label)"
    # walk: the furthest end so far for each priority; a place that ends before one is inside it. What is
    # left is gathered in chunks, as each addition copies the array it is added to
    walked = found.withColumn(
        "left",
        F.expr(
            f"aggregate(hits, struct(0 AS e1, 0 AS e2, 0 AS e3, CAST(array() AS array<{_LEFT}>) AS at, CAST(array() AS array<array<{_LEFT}>>) AS done), "
            "(a, h) -> struct("
            "IF(h.priority = 1, greatest(a.e1, -h.minus_e), a.e1) AS e1, "
            "IF(h.priority <= 2, greatest(a.e2, -h.minus_e), a.e2) AS e2, "
            "greatest(a.e3, -h.minus_e) AS e3, "
            f"IF({inside}, a.at, IF(size(a.at) >= {CHUNK}, array({place}), concat(a.at, array({place})))) AS at, "
            f"IF({inside} OR size(a.at) < {CHUNK}, a.done, concat(a.done, array(a.at))) AS done), "
            "a -> flatten(concat(a.done, array(a.at))))"
        ),
    )

    none = F.array().cast("array<string>")
    base_labels = F.coalesce(F.transform("base", lambda p: p.label), none)
    labels = F.coalesce(F.transform("left", lambda p: p.label), none)
    best = F.array_min(F.transform("left", lambda p: p.priority))
    score = F.when(F.size("base") > 0, F.lit(CONFIDENCE[NAME])).otherwise(F.lit(0.0))
    for priority in (REMARK, NAME, STATEMENT):
        score = F.when(best == priority, F.greatest(score, F.lit(CONFIDENCE[priority]))).otherwise(score)
    return walked.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.when(F.size("base") > 0, F.col("base")[0].s.cast("long")).alias("first_word"),
        F.when(F.size("base") > 0, F.element_at("base", -1).s.cast("long")).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, labels))), ",").alias("labels"),
        score.alias("score"),
        F.coalesce(
            F.transform(
                "left",
                lambda p: F.struct(
                    p.label.alias("label"),
                    p.priority.alias("priority"),
                    p.s.cast("long").alias("first_word"),
                    (p.e - p.s).alias("n_words"),
                ),
            ),
            F.array().cast("array<struct<label: string, priority: int, first_word: bigint, n_words: int>>"),
        ).alias("detections"),
    )
