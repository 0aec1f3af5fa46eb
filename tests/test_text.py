"""Golden values for the text expressions (edge cases listed in FIXTURES.md B5)."""

import pytest
from pyspark.sql import functions as F

from qalam.functions import text as T
from qalam.operators.profile import format_ratio


def one(spark, col, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(col.alias("y")).first()["y"]


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("- a -", "a"),
        ("\\n a \\n", "a"),
        ("\r\n-- text --\n\r", "text"),
        ("-\\n- \\n -", ""),
        ("a - b", "a - b"),
        ("x\\\\n", "x\\"),
        ("\\\\n x", "\\\\n x"),
        ("ab\\\n", "ab\\"),
        (None, ""),
    ],
)
def test_clean_boundaries(spark, raw, expected):
    assert one(spark, T.clean_boundaries("x"), raw) == expected


def test_clean_boundaries_long_markers_linear(spark):
    raw = ("-\\n" * 20000) + "core" + (" -" * 20000)
    assert one(spark, T.clean_boundaries("x"), raw) == "core"


@pytest.mark.parametrize("ch", ["\t", " ", " ", "\u001c", "　", "\u0085"])
def test_strip_unicode_whitespace(spark, ch):
    raw = f"{ch}{ch}word {ch}word{ch}"
    assert one(spark, T.strip_text("x"), raw) == raw.strip()


def test_diacritics(spark):
    s = "مَرْحَبًا"
    assert one(spark, T.strip_diacritics("x"), s) == "مرحبا"
    assert one(spark, T.count_diacritics("x"), s) == 4


def test_collapse_whitespace(spark):
    for s in ["a  b\t\tc", " a b ", "a b", "x   y", "plain text"]:
        assert one(spark, T.collapse_whitespace("x"), s) == " ".join(s.split())


def test_astral_length_and_words(spark):
    assert one(spark, T.char_count("x"), "😀a") == 2
    assert one(spark, T.word_count("x"), "") == 0
    assert one(spark, T.word_count("x"), None) == 0
    assert one(spark, T.word_count("x"), " a b\tc  ") == 3


def test_swap_mask_all_combinations(spark):
    # (en has Arabic, en has Latin, ar has Arabic, ar has Latin)
    samples = {(True, False): "مرحبا", (False, True): "hello", (True, True): "hi مرحبا", (False, False): "123"}
    rows, expected = [], []
    for ea, el in samples:
        for aa, al in samples:
            rows.append((samples[(ea, el)], samples[(aa, al)]))
            expected.append(ea and al and ((not el) or (not aa)))
    df = spark.createDataFrame(rows, "en string, ar string")
    got = [r[0] for r in df.select(T.swap_mask("en", "ar")).collect()]
    assert got == expected
    assert sum(expected) == 3


def test_detect_direction(spark):
    df = spark.createDataFrame([("مرحبا",), ("hello",), ("   ",), (None,)], "t string")
    got = [r[0] for r in df.select(T.detect_direction("t")).collect()]
    assert got == ["ar_to_en", "en_to_ar", "", ""]
    with pytest.raises(ValueError):
        T.detect_direction("t", "sideways")


def test_format_ratio(spark):
    df = spark.createDataFrame([(0.0,), (0.033865,), (0.000022,)], "r double")
    got = [r[0] for r in df.select(format_ratio("r")).collect()]
    assert got == ["0.0%", "3.3865%", "0.0022%"]


def test_percentile_linear(spark):
    df = spark.range(1, 101).select(F.col("id").alias("v"))
    assert df.select(F.percentile("v", 0.9)).first()[0] == pytest.approx(90.1)


def test_word_count_and_collapse_match_python_on_random_text(spark):
    """Seeded random strings over every character Python's ``str.split`` treats as whitespace,
    plus letters and boundary markers: ``word_count == len(s.split())`` and
    ``collapse_whitespace(s) == " ".join(s.split())``."""
    import random

    from qalam.functions import text as T

    ws = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    alphabet = ws + ["a", "b", "ب", "-", "\\", "n", "é", "😀"]
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(600)]
    texts += ["", " ", "a", " a ", "\x1c\x1da\x1e", "　x  y\xa0"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", T.word_count("t").alias("wc"), T.collapse_whitespace("t").alias("cw")).collect()
    for r in out:
        s = texts[r["i"]]
        assert r["wc"] == len(s.split()), repr(s)
        assert r["cw"] == " ".join(s.split()), repr(s)


def test_white_space_as_python_has_it(spark):
    """Trims, word counts and one-pass cleaning against Python, for white space and marks in any place."""
    import random
    import re

    rng = random.Random(3)
    pool = [*T.WS_CHARS, "  ", "\\n", "\\", "n", "-", "a", "é", "م", "\u064b", "\u0670", "\U0001f600", "\x00", "\u200b"]
    texts = ["".join(rng.choices(pool, k=rng.randrange(12))) for _ in range(3000)] + ["", "a" * 20_000 + " " * 20_000]
    assert [c for c in map(chr, range(0x3001)) if c.isspace()] == sorted(T.WS_CHARS)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select(
        "i", T.strip_text("x").alias("s"), T.word_count("x").alias("w"), T.collapse_whitespace("x").alias("c"),
        T.strip_diacritics_and_collapse("x").alias("d"), T.clean_boundaries("x").alias("b"), T.has_arabic("x").alias("a"),
    )
    marks = rf"(?:[{re.escape(T.WS_CHARS)}-]|\\n)+"
    for r in df.collect():
        t = texts[r.i]
        lead = re.sub(rf"\A{marks}", "", t)
        assert (r.s, r.w, r.c) == (t.strip(), len(t.split()), " ".join(t.split()))
        assert r.d == " ".join(re.sub(f"[{T.DIACRITIC_CHARS}]", "", t).split())
        assert r.b == re.sub(rf"{marks}\Z", "", lead) and r.a == bool(re.search("[\u0600-\u06ff]", t))
