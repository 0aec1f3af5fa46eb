"""Periodic runs against all lags of all words."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from qalam.llm import periodic_runs as PR
from qalam.llm import queries as Q


def runs_by_hand(words, min_words=24, min_repeats=3):
    found = {}
    for p in range(1, len(words) // min_repeats + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(min_words, min_repeats * p):
                found.setdefault((i, j - i + p), p)  # lags ascend
            i = j + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def best_of(runs):
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def altered(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def random_texts(rng, n):
    """Runs of many periods, nested and side by side, in few and in many different words."""
    for _ in range(n):
        words, alphabet = [], rng.choice([2, 3, 50, 10**6])
        for _ in range(rng.randrange(1, 6)):
            block = [rng.randrange(alphabet) for _ in range(rng.choice([1, 2, 3, 7, 16, 17, 23, 24, 25, 31, 33, 48, 50, 97, 130]))]
            if rng.random() < 0.4:
                inner = block[: rng.randrange(1, len(block) + 1)]
                block = inner * rng.randrange(2, 12) + block
            more = block * rng.randrange(1, 8)
            words += more[: rng.randrange(1, len(more) + 1)]
            words += [rng.randrange(alphabet) for _ in range(rng.randrange(0, 30))]
        yield [f"w{x}" for x in words]


@pytest.mark.parametrize("seed", range(4))
def test_find_runs(seed):
    rng = random.Random(seed)
    texts = [w for w in random_texts(rng, 60) if len(w) < 1500]
    number = {w: i for i, w in enumerate({w for t in texts for w in t})}
    keys = np.array([number[w] + (i << 32) for i, t in enumerate(texts) for w in t], np.uint64)
    sizes = np.array([len(t) for t in texts])
    got = PR.find_runs(PR.mixed(keys), sizes)
    at, want = 0, []
    for t in texts:
        want += [(s + at, n, p) for s, n, p in runs_by_hand(t)]
        at += len(t)
    assert [tuple(r) for r in got.tolist()] == want
    assert want


def test_every_period_is_found_at_its_least_length():
    """Three repeats and not a word more, for every period around the ends of the scales."""
    rng, texts = random.Random(5), []
    for p in [*range(8, 140), 191, 192, 193, 255, 256, 257, 383, 384, 385, 511, 512, 513, 700]:
        block = [rng.randrange(10**9) for _ in range(p)]
        texts.append([rng.randrange(10**9) for _ in range(rng.randrange(40))] + block * 3 + [rng.randrange(10**9) for _ in range(rng.randrange(40))])
    keys = np.concatenate([np.array(t, np.uint64) + np.uint64(i << 32) for i, t in enumerate(texts)])
    got = PR.find_runs(PR.mixed(keys), np.array([len(t) for t in texts]))
    assert [r[2] for r in got.tolist()] == [*range(8, 140), 191, 192, 193, 255, 256, 257, 383, 384, 385, 511, 512, 513, 700]


def test_query_against_all_lags(spark, documents):
    got = {r.doc_id: r for r in Q.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    some = 0
    for doc_id, text in rows:
        words = altered(doc_id, words_of(text))
        runs = runs_by_hand(words)
        best, r = best_of(runs), got[doc_id]
        some += bool(runs)
        want = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *want)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert some > 10


def test_awkward(awkward, empty):
    got = PR.periodic_runs(awkward)
    assert got.columns == ["doc_id", "n_words", "runs", "best", "text"]
    rows = awkward.select("doc_id", "text").collect()
    want = sorted(repr((i, len(words_of(t)), runs_by_hand(words_of(t)[:400]) and None, "")) for i, t in rows if not t)
    assert len(got.collect()) == len(rows)
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[1].n_words == by_id[2].n_words == by_id[3].n_words == 0 and len(want) == 2
    assert by_id[1].text == by_id[2].text == by_id[3].text == "" and by_id[1].best is None
    long = by_id[4]
    assert [tuple(r) for r in long.runs] == [(0, 20_000, 5)] and long.text == "lorem ipsum dolor sit amet"
    assert None in by_id
    assert PR.periodic_runs(empty).collect() == []
    assert PR.with_repeated_tails(empty).collect() == []


def test_repeated_tails_of_awkward_rows(awkward):
    got = {r.doc_id: r.text for r in PR.with_repeated_tails(awkward).collect()}
    for doc_id, text in awkward.select("doc_id", "text").collect():
        words = words_of(text)
        assert words_of(got[doc_id]) == altered(doc_id, words)
