"""Exact dedup, licence scan, quality rules and url trust against brute force."""

import hashlib
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from qalam.llm import exact_dedup as ED
from qalam.llm import license_scan as LS
from qalam.llm import quality_rules as QR
from qalam.llm import url_trust as UT


def texts_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


# exact dedup


def dedup_by_hand(docs):
    groups = {}
    for doc_id, text in texts_of(docs):
        groups.setdefault(text, []).append(doc_id)
    out = []
    for doc_id, text in texts_of(docs):
        keep = max((i for i in groups[text] if i is not None), default=None)
        out.append((doc_id, keep, len(groups[text]), doc_id == keep, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize(("key_bits", "capacity"), [(64, None), (64, 3), (3, None), (0, 2)])
def test_exact_dedup(documents, awkward, key_bits, capacity):
    """Few key bits make texts collide: chains, and buckets that splitting can't help."""
    docs = documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    got = ED.exact_dedup(docs, capacity=capacity, key_bits=key_bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == dedup_by_hand(docs)


def test_exact_dedup_ignores_other_columns_and_empty_tables(awkward, empty):
    assert Counter(map(tuple, ED.exact_dedup(awkward).collect())) == dedup_by_hand(awkward)
    assert ED.exact_dedup(empty).collect() == []


def test_directory_splits_overfull_buckets(documents):
    entries = ED.distinct_texts(documents)
    rows = ED.directory(entries, capacity=10).collect()
    top = rows[0].top
    buckets = {}
    for r in rows:
        buckets.setdefault((r.bucket, r.depth), set()).add(r.cell)
    keys = [(r.key & (1 << 64) - 1) >> (64 - top) for r in entries.collect()]
    for (bucket, depth), cells in buckets.items():
        inside = range(bucket, bucket + (1 << (top - depth)))
        assert cells <= set(inside)
        n = sum(k in inside for k in keys)
        assert n <= 10 or depth == top
        if depth:  # the bucket it was split from was overfull
            width = 1 << (top - depth + 1)
            parent = range(bucket // width * width, bucket // width * width + width)
            assert sum(k in parent for k in keys) > 10


# licence scan


def scan_by_hand(text, rules):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    joined = f" {' '.join(words)} "

    def places(pattern):
        return [(m.start(), m.end()) for m in re.finditer(rf"(?<= )(?:{pattern})(?= )", joined)]

    def word(start):
        return joined[:start].count(" ") - 1

    base = sorted((s, label) for phrase, label in LS.BASE_PHRASES for s, _ in places(phrase))
    hits = [(s, e, r.priority, i, r.label) for i, r in enumerate(rules) if r.keyword in joined for s, e in places(r.pattern)]

    def inside(a, b):
        return b[2] <= a[2] and b[0] <= a[0] and a[1] <= b[1] and ((b[0], b[1]) != (a[0], a[1]) or b[2:4] < a[2:4])

    left = [a for a in hits if not any(inside(a, b) for b in hits if b is not a)]
    labels = {label for _, label in base}
    best = min((a[2] for a in left), default=None)
    score = max(LS.CONFIDENCE[best] if best else 0.0, LS.CONFIDENCE[LS.NAME] if base else 0.0)
    ends = (word(base[0][0]), word(base[-1][0])) if base else (None, None)
    return (len(words), len(base), *ends, ",".join(sorted(labels)), ",".join(sorted(labels | {a[4] for a in left})), score)


LICENCE_TEXTS = [
    "CC BY cc-by CC BY-NC 4.0 cc by",
    "All rights reserved. all Rights RESERVED GNU General Public License v2 or later. Licensed under the MIT License x " * 20,
    "Creative Commons Attribution-NonCommercial 4.0 International License; SPDX-License-Identifier: MIT",
    "l\u0130cense \u212a cc by \U0001f600 general public license",
    "released under the terms of the Apache License, Version 2.0; see the BSD 3-Clause License or the ISC license",
    "cc cc by by cc by",
]


def test_license_scan(spark, documents, awkward):
    rules = LS.signature_rules()
    assert len(rules) > 300
    more = spark.createDataFrame([(100_000 + i, t) for i, t in enumerate(LICENCE_TEXTS)], "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text")).unionByName(more)
    want = Counter((i, *scan_by_hand(t, rules)) for i, t in texts_of(docs))
    got = LS.license_scan(docs)
    assert Counter(tuple(r)[:8] for r in got.collect()) == want


def test_every_rule_is_behind_its_keyword_and_the_gate():
    """A rule's keyword, and one of the gate's words, is in what it matches or beside it."""
    for rule in LS.signature_rules():
        assert rule.keyword == rule.keyword.lower()
        re.compile(rule.pattern)


def expansions(parsed):
    """Strings that a parsed regex matches: every branch, and every optional part left out and put in."""
    found = [""]
    for op, value in parsed:
        if str(op) == "LITERAL":
            one = [chr(value)]
        elif str(op) == "IN":
            one = [chr(x) if str(kind) == "LITERAL" else "7" for kind, x in value]
        elif str(op) == "SUBPATTERN":
            one = expansions(value[3])
        elif str(op) == "BRANCH":
            one = [x for branch in value[1] for x in expansions(branch)]
        else:
            low, _, inner = value
            one = [""] * (low == 0) + expansions(inner)
        found = [a + b for a in found for b in dict.fromkeys(one)]
    return found


def test_all_that_a_rule_matches_has_its_keyword_and_a_word_of_the_gate():
    lost = []
    for rule in LS.signature_rules():
        pattern = rule.pattern.replace(LS._NOTICE, "licensed under")
        texts = expansions(re._parser.parse(pattern))
        assert all(re.fullmatch(pattern, t) for t in texts)
        lost += [(rule.label, rule.keyword, t) for t in texts if rule.keyword not in t or not any(g in t for g in LS.GATE)]
    assert lost == []


ALTERNATIVE_NAMES = {
    "Released under the WTFPL": "wtfpl",
    "see the Expat License": "mit",
    "under the Free Public License": "0bsd",
    "a PSF license": "psf-2.0",
    "the Responsible AI License applies": "openrail",
    "GPL version 2 or any later": "gpl-2.0-or-later",
    "Published under a CC BY-SA 4.0": "cc-by-sa-4.0",
}


def test_license_scan_equals_all_rules_without_keywords(spark, documents):
    every = [replace(r, keyword="") for r in LS.signature_rules()]
    more = spark.createDataFrame([(100_000 + i, t) for i, t in enumerate([*ALTERNATIVE_NAMES, *LICENCE_TEXTS])], "doc_id long, text string")
    docs = documents.select("doc_id", "text").filter("length(text) < 3000").unionByName(more)
    got = LS.license_scan(docs).collect()
    assert Counter(tuple(r)[:8] for r in got) == Counter((i, *scan_by_hand(t, every)) for i, t in texts_of(docs))
    labels = {r.doc_id: r.labels.split(",") for r in got}
    assert all(label in labels[100_000 + i] for i, label in enumerate(ALTERNATIVE_NAMES.values()))


def test_license_suppression(spark):
    rules = [
        LS.Rule("long", "licen", "the mit license text", LS.STATEMENT),
        LS.Rule("short", "licen", "mit license", LS.STATEMENT),
        LS.Rule("weak", "licen", "the mit license text", LS.REMARK),
        LS.Rule("overlap", "licen", "license text here", LS.STATEMENT),
        LS.Rule("strong", "licen", "text", LS.STATEMENT),
        LS.Rule("wide", "licen", "see the mit license text here", LS.REMARK),
    ]
    docs = spark.createDataFrame([(1, "See the MIT License text here. License!")], "doc_id long, text string")
    row = LS.license_scan(docs, rules).first()
    # a remark suppresses nothing better than itself; overlaps that aren't inside stay
    assert row.labels == "long,overlap,wide"
    assert [d.label for d in row.detections] == ["wide", "long", "overlap"]


def test_license_scan_of_a_long_text_of_licences(spark):
    """Half a megabyte of nothing but licence remarks; every place is found and kept."""
    n = 9000
    docs = spark.createDataFrame([(1, "Licensed under the MIT License. All rights reserved cc by " * n)], "doc_id long, text string")
    row = LS.license_scan(docs).first()
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (10 * n, 2 * n, 5, 10 * n - 2)
    statements = [d for d in row.detections if d.priority == LS.STATEMENT]
    assert len(statements) == n and [d.first_word for d in statements] == [10 * i for i in range(n)]
    assert {"mit", "reserved", "cc-by"} <= set(row.labels.split(",")) and row.score == 1.0


def test_license_scan_awkward(awkward, empty):
    assert LS.license_scan(awkward).count() == awkward.count()
    assert LS.license_scan(empty).collect() == []


# quality rules


def measures_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_rules(documents, awkward):
    docs = documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    got = QR.quality_rules(docs).collect()
    assert Counter(tuple(r)[:7] for r in got) == Counter((i, *measures_by_hand(t)) for i, t in texts_of(docs))
    assert not any(r.kept and r.base_failed for r in got)


def test_quality_repeats(spark):
    cases = ["a b c a b c", "a a a a", "a b c d a b c e b c d", "x y", "x y z", "p q r p q", "1 2 3 9 1 2 3 9 1 2 3"]
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in QR.quality_rules(docs).collect()}
    assert got == {i: measures_by_hand(t)[4] for i, t in enumerate(cases)}


def test_quality_keeps_clean_prose_and_all_columns(documents, awkward, empty, labels):
    kept = {r.doc_id for r in QR.with_quality(documents).select("doc_id").collect()}
    failed = {r.doc_id for r in QR.quality_rules(documents).filter("base_failed").collect()}
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert good - failed <= kept
    assert QR.with_quality(awkward).columns == awkward.columns
    want = Counter(r.doc_id for r in QR.quality_rules(awkward).filter("kept").collect())
    assert Counter(r.doc_id for r in QR.with_quality(awkward).collect()) == want
    assert QR.quality_rules(empty).collect() == QR.with_quality(empty).collect() == []


CLEAN_PROSE = {
    "ru": "Утром над рекой стоял густой туман и рыбаки долго ждали пока солнце поднимется над лесом",
    "ar": "جلس الرجل العجوز قرب النافذة ينظر إلى الشارع ويفكر في أيام الطفولة البعيدة والمدينة القديمة",
    "hi": "सुबह नदी के ऊपर घना कोहरा था और मछुआरे बहुत देर तक सूरज निकलने की राह देखते रहे",
    "pl": "Rano nad rzeką wisiała gęsta mgła, rybacy długo czekali, aż słońce wzejdzie ponad lasem",
    "fi": "Aamulla joen yllä leijui sakea sumu ja kalastajat odottivat pitkään auringon nousua metsän takaa",
    "tr": "Sabah nehrin üzerinde yoğun bir sis vardı, balıkçılar güneşin doğmasını uzun süre beklediler",
}


def test_quality_keeps_clean_prose_of_other_languages(spark):
    """The stop words judge texts in their own languages and script, whatever the others say."""
    numbered = {lang: " ".join(f"{w}{k}" for k in range(6) for w in t.split()) for lang, t in CLEAN_PROSE.items()}
    rows = [(i, t, lang) for i, (lang, t) in enumerate(numbered.items())]
    rows += [(10, numbered["ru"], "en"), (11, numbered["fi"], None), (12, numbered["tr"], "TR-tr")]
    junk = " ".join(f"keyword{k}" for k in range(80))
    rows += [(20, junk, "en"), (21, junk, "de-AT"), (22, junk, "FRA")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.kept, r.stop_word_ratio < 0.05) for r in QR.quality_rules(docs).collect()}
    assert got == {i: (i < 20, True) for i, _, _ in rows}
    assert {r.doc_id for r in QR.with_quality(docs).collect()} == {i for i, _, _ in rows if i < 20}
    assert all(r.kept for r in QR.quality_rules(docs.drop("lang")).filter("doc_id < 20").collect())


def test_quality_plan_is_one_projection(documents):
    plan = QR.quality_rules(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Join|Python|Arrow", plan)


# url trust

URLS = [
    ("http://Example.COM/en/x?q#f", "example.com", "/en/x", "example.com/en/", "block"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("https://example.com/de/", "example.com", "/de/", "com/", "allow"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
    ("http://net/fr/", "net", "/fr/", "net/fr/", "block"),
    ("http://x.com", "x.com", "", None, "allow"),
    ("http://x.com?a=/", "x.com", "", None, "allow"),
    ("ftp://h#frag/x", "h", "", None, "allow"),
    ("no scheme.com/en/", "", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("://", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u[0], None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    got = {r.page_id: tuple(r)[1:4] for r in UT.url_filter(pages).collect()}
    assert got == {i: u[1:4] for i, u in enumerate(URLS)}
    ruled = {r.page_id: r.verdict for r in UT.url_filter(pages).filter("rule IS NOT NULL").collect()}
    assert ruled == {i: u[4] for i, u in enumerate(URLS) if u[3]}


def rank_by_hand(seeds, links, rounds):
    score = {h: 0.15 * w for h, w in seeds.items()}
    start = dict(score)
    for _ in range(rounds):
        new = dict(start)
        for (a, b), share in links.items():
            if a in score:
                new[b] = new.get(b, 0) + 0.85 * share * score[a]
        score = new
    return score


def link(*hosts):
    return "".join(f'<A class=x HREF="https://{h}/p">t</a>' for h in hosts)


GRAPH = [
    (1, "http://good.com/a", link("mid.org", "GOOD.com")),
    (2, "http://mid.org/b", link("far.org") + '<a href="/relative">r</a><a href="//cdn.org/x">c</a>'),
    (3, "http://spam.net/es/1", link("mid.org")),
    (4, "http://farm.org/1", link("spam.net", "spam.net", "mid.org")),
    (5, "http://farm2.org/1", link("farm.org")),
    (6, "http://far.org/1", None),
    (7, "http://m.spam.net/1", ""),
    (8, "http://lonely.org/1", "<p>no links"),
]


def test_url_propagation(spark):
    pages = spark.createDataFrame(GRAPH, "page_id long, url string, html string")
    n = {("good.com", "mid.org"): 1, ("mid.org", "far.org"): 1, ("mid.org", "cdn.org"): 1, ("spam.net", "mid.org"): 1}
    n |= {("farm.org", "spam.net"): 2, ("farm.org", "mid.org"): 1, ("farm2.org", "farm.org"): 1}
    n |= {("m.spam.net", "spam.net"): 1, ("spam.net", "m.spam.net"): 1}
    out, into = Counter(), Counter()
    for (a, b), k in n.items():
        out[a] += k
        into[b] += k
    trust = rank_by_hand({"good.com": 1}, {(a, b): k / out[a] for (a, b), k in n.items()}, UT.ROUNDS)
    distrust = rank_by_hand({"spam.net": 1}, {(b, a): k / into[b] for (a, b), k in n.items()}, UT.ROUNDS)
    got = {r.host: (r.trust, r.distrust) for r in UT.host_scores(pages).collect()}
    assert set(got) == {u.split("/")[2] for _, u, _ in GRAPH}
    for host, (t, d) in got.items():
        assert t == pytest.approx(trust.get(host, 0)) and d == pytest.approx(distrust.get(host, 0))
    verdicts = {r.page_id: r.verdict for r in UT.url_filter(pages).collect()}
    # links to spam cost trust, links from it don't
    assert verdicts == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "block", 8: "allow"}


def test_url_filter_awkward(spark):
    pages = spark.createDataFrame(
        [(None, None, None, "h"), (1, "http://a.com/x", None, "h"), (1, "http://a.com/x", None, "h")],
        "page_id long, url string, html string, host string",
    )
    assert UT.url_filter(pages).count() == 3
    assert UT.url_filter(pages.limit(0)).collect() == []


def test_native_plans_have_no_python(documents, spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for df in (ED.exact_dedup(documents), LS.license_scan(documents), UT.url_filter(pages)):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())
    assert documents.select(F.lit(1)).count() > 0
