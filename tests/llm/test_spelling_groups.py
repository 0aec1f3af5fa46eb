"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from qalam.llm import queries as Q
from qalam.llm import spelling_groups as SG


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def near_by_hand(words):
    words = sorted(words)
    return {w: [x for x in words if is_near(w, x)] for w in words}


def groups_by_hand(n, times=10):
    near, form = near_by_hand(n), {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def vocabulary_by_hand(rows, drop_every=31, min_length=7, min_count=2):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if drop_every and doc_id is not None and h % drop_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= min_length and k >= min_count}


def random_words(rng, n, letters, lengths):
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.choice(lengths)))
        words.add(w)
        for _ in range(rng.randrange(4)):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            words.add(rng.choice([w[:i] + w[i + 1 :] or c, w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w + c, w[1:] + c]))
    return {w: rng.choice([2, 3, 25, 300, 300, 4000]) for w in words}


@pytest.mark.parametrize(
    ("letters", "lengths", "groups", "parts", "bound"),
    [("ab", [3, 4, 5, 6, 7, 8, 9], 1, 3, 2), ("abé", [1, 2, 3, 7, 8], 2, 3, 4), ("etaoinß", [7, 8, 9, 10, 11], 1, 4, 3), ("xyzЖ\U0001f600", [5, 6, 7], 1, 3, 32)],
)
def test_all_near_pairs_once(spark, letters, lengths, groups, parts, bound):
    """Few letters make large groups, which are halved down to one open letter; letters beyond the
    table have a part too."""
    n = random_words(random.Random(7), 250, letters, lengths)
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = [(r.word, r.near) for r in SG.near_words(words, groups, parts, bound).collect()]
    assert Counter(got) == Counter((w, x) for w, others in near_by_hand(n).items() for x in others)


def test_groups(spark):
    n = random_words(random.Random(3), 300, "abcdefgh", [7, 8])
    words = spark.createDataFrame(list(n.items()), "word string, n long").withColumns({"form": F.lit("x"), "key": F.lit(1)})
    got = SG.spelling_groups(words, bound=8)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(n) and set(rows) == groups_by_hand(n)


def test_roots_follow_forms_to_the_last(spark):
    n = {"aaaaaaa": 10**5, "aaaaaab": 10**4, "aaaaabb": 10**3, "aaaabbb": 100, "aaabbbb": 10, "aabbbbb": 2, "zzzzzzz": 2}
    got = {r.word: r for r in SG.spelling_groups(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert got["aaabbbb"].root == "aaaaaaa" and got["aaabbbb"].form == "aaaabbb"
    assert got["aabbbbb"].form is None and got["aabbbbb"].root == "aabbbbb" and got["aabbbbb"].n_near == 1
    assert tuple(got["zzzzzzz"]) == ("zzzzzzz", None, "zzzzzzz", 2, 0, None)


def test_query_against_all_pairs(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    want = groups_by_hand(vocabulary_by_hand(rows))
    got = [tuple(r) for r in Q.op11_spelling_groups(spark, "/root/testdata/sf0.001").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert any(g[1] for g in got)


def test_vocabulary_awkward(spark, awkward, empty):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    more = [(20, "Straße×ÿÀÉé STRASSE strasse " * 3), (21, "x" * 60_000 + " " + "x" * 60_000), (None, "abcdefgh abcdefgh")]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    for every in (None, 1, 2, 31):
        want = vocabulary_by_hand(rows + more, every)
        assert {r.word: r.n for r in SG.vocabulary(docs, drop_every=every).collect()} == want
    assert {r.word for r in SG.spelling_groups(SG.vocabulary(docs)).collect()} == set(vocabulary_by_hand(rows + more, None))
    assert {r.word for r in SG.vocabulary(awkward).collect()} == set(vocabulary_by_hand(rows, None))
    assert SG.vocabulary(empty).collect() == SG.spelling_groups(SG.vocabulary(empty)).collect() == []
