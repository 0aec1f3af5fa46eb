"""BLEU/chrF: hand-computed values and degenerate cases."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from qalam.functions import ngram as N
from qalam.operators import score as SC


def score(spark, pairs, direction="en_to_ar"):
    df = spark.createDataFrame([(i, direction, p, r) for i, (p, r) in enumerate(pairs)], "row_id long, direction string, prediction string, target_text string")
    return SC.scores_by_direction(df).where("direction IS NULL").first()


def test_bleu_hand_computed(spark):
    r = score(spark, [("the cat sat on the mat", "the cat is on the mat")])
    # p1=5/6 p2=3/5 p3=1/4 p4: no match -> 1/(2*3); no brevity penalty
    expected = 100 * math.exp((math.log(5 / 6) + math.log(3 / 5) + math.log(1 / 4) + math.log(1 / 6)) / 4)
    assert r["bleu"] == pytest.approx(expected, rel=1e-12)


def test_perfect_and_empty(spark):
    r = score(spark, [("a b c d e", "a b c d e"), ("x y z w", "x y z w")])
    assert r["bleu"] == pytest.approx(100.0) and r["chrf"] == pytest.approx(100.0)
    r = score(spark, [("", "a b c d")])
    assert r["bleu"] == 0.0 and r["chrf"] == 0.0


def test_brevity_penalty(spark):
    r = score(spark, [("a b c d", "a b c d e f g h")])
    assert r["bleu"] == pytest.approx(100 * math.exp(1 - 8 / 4))


def split_13a(line):
    line = line.replace("<skipped>", "").replace("-\n", "").replace("\n", " ")
    line = line.replace("&quot;", '"').replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
    line = f" {line} "
    for pattern, new in N.RE_13A:
        line = re.sub(pattern, new, line)
    return line.split()


def stats_by_hand(hyp, ref):
    """Counters of one row."""
    def clipped(h, r, n):
        h, r = (Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (h, r))
        return h.total(), r.total(), (h & r).total()

    h, r = split_13a(hyp), split_13a(ref)
    out = {"hyp_len": len(h), "ref_len": len(r)}
    for n in range(1, 5):
        out[f"t{n}"], _, out[f"m{n}"] = clipped(h, r, n)
    h, r = "".join(hyp.split()), "".join(ref.split())
    for n in range(1, 7):
        out[f"ch{n}"], out[f"cr{n}"], out[f"cm{n}"] = clipped(h, r, n)
        out[f"ch{n}"] *= out[f"cr{n}"] > 0
    return out


def test_tokenizer_13a():
    texts = ["Hello, world. 3.5 cats-1", "a&amp;b"]
    got = [[t for t in x.split() if t] for x in N.tokenize_13a(pa.array(texts)).to_pylist()]
    assert got == [["Hello", ",", "world", ".", "3.5", "cats-1"], ["a", "&", "b"]] == [split_13a(t) for t in texts]


def test_chrf_stats_reference_without_order():
    # reference too short for order 3+: hypothesis n-grams of those orders are not counted
    st = N.row_stats(pa.array(["abcd"]), pa.array(["ab"]))
    assert [st[f"c{k}3"].tolist() for k in "hrm"] == [[0], [0], [0]]


@pytest.mark.parametrize(("alphabet", "rows"), [("ab ", 300), ("ab c.,-1\n&;\t\x1f\x85\u00a0\u2003é", 400), ("wide", 40)])
def test_row_statistics_against_counters(monkeypatch, alphabet, rows):
    """Few letters repeat n-grams, many do not fit side by side into a number; slices join up."""
    rng = random.Random(rows)
    monkeypatch.setattr(N, "SLICE_ROWS", 64)
    pool = [chr(c) for c in range(0x4E00, 0x9E00)] if alphabet == "wide" else [*alphabet, "&amp;", "<skipped>", "-\n", "3.5", "the ", "the cat "]
    text = lambda: "".join(rng.choices(pool, k=rng.choice([0, 1, 2, 5, 30, 200])))
    hyps = [text() for _ in range(rows)]
    refs = [h[: rng.randrange(len(h) + 1)] + text() if rng.random() < 0.7 else text() for h in hyps]
    hyps, refs = [*hyps, None, "a b", ""], [*refs, "a b", None, ""]
    got = N.stats_struct(pa.array(hyps, pa.string()), pa.array(refs, pa.string())).to_pylist()
    assert got == [{f: stats_by_hand(h or "", r or "")[f] for f in N.STAT_FIELDS} for h, r in zip(hyps, refs, strict=True)]
    assert N.stats_struct(pa.array([], pa.string()), pa.array([], pa.string())).to_pylist() == []


def test_chrf_value(spark):
    r = score(spark, [("abcd", "abce")])
    # orders 1..3 valid: P = R = (3/4 + 2/3 + 1/2)/3 ; order 4: hyp 1, ref 1, match 0 -> valid, adds 0
    p = (3 / 4 + 2 / 3 + 1 / 2 + 0) / 4
    assert r["chrf"] == pytest.approx(100 * 5 * p * p / (4 * p + p))


def test_eval_record_empty(spark):
    df = spark.createDataFrame([], "row_id long, direction string, prediction string, target_text string")
    rec = SC.eval_record(SC.scores_by_direction(df)).first()
    assert rec["num_samples"] == 0 and math.isnan(rec["bleu"])


def test_slices_are_bounded_by_bytes(monkeypatch):
    """Long texts are worked on a few at a time, with the same statistics."""
    import random

    import pyarrow as pa

    from qalam.functions import ngram as N

    rng = random.Random(5)
    texts = [" ".join(rng.choices(["the", "cat,", "é", "12-3", "مرحبا"], k=rng.randrange(300))) for _ in range(200)] + ["", None, "x" * 5000]
    hyps, refs = pa.array(texts), pa.array(texts[::-1])
    whole = N.stats_struct(hyps, refs).to_pylist()
    seen, stats = [], N.row_stats

    def measured(h, r):
        seen.append((len(h), max(h.nbytes, r.nbytes)))
        return stats(h, r)

    monkeypatch.setattr(N, "SLICE_BYTES", 10_000)
    monkeypatch.setattr(N, "row_stats", measured)
    assert N.stats_struct(hyps, refs).to_pylist() == whole
    assert sum(n for n, _ in seen) == len(texts) and len(seen) > 20
    assert max(b for n, b in seen if n > 1) < 20_000
    assert N.stats_struct(pa.array([], pa.string()), pa.array([], pa.string())).to_pylist() == []
