"""Toxicity, line dedup, near dedup and the pipeline against brute force and held-out labels."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from qalam.llm import line_dedup as LD
from qalam.llm import near_dedup as ND
from qalam.llm import toxicity as TX
from qalam.llm.components import connected_components
from qalam.llm.shingles import shingles, word_hashes
from qalam.llm.tables import stage

SF01 = "/root/testdata/sf0.01"


def texts_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


# toxicity


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    rows = TX.toxicity(docs, labels).collect()
    return rows, {r.doc_id: r.toxic for r in labels.collect()}


def test_toxicity_on_held_out_rows(scored):
    rows, labels = scored
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [h for h in held if h[2]], [h for h in held if not h[2]]
    wins = sum((t[0] > c[0]) + (t[0] == c[0]) / 2 for t in toxic for c in clean)
    assert wins / (len(toxic) * len(clean)) > 0.85
    assert sum(c[1] for c in clean) <= 0.03 * len(clean)


NEUTRAL = ["the {} family went to the market", "a {} neighbour baked bread for us", "our {} friends sang all evening"]
HOSTILE = ["you {} idiot get lost", "stupid {} scum everywhere", "what a worthless {} loser"]
PLAIN = ["you idiot get lost", "the bus was late again", "stupid scum everywhere", "we planted beans and peas"]


def biased(spark):
    """One group's name stands in most toxic texts, its neighbours' names in neutral ones."""
    rng, rows = random.Random(3), []
    for i in range(900):
        toxic = i % 3 == 0
        group = ("muslim" if rng.random() < 0.9 else "hindu") if toxic else rng.choice(["christian", "jewish", "hindu", "muslim"][: 3 + (i % 9 == 1)])
        text = rng.choice(HOSTILE if toxic else NEUTRAL).format(group) if rng.random() < 0.8 else rng.choice(PLAIN[:1] + PLAIN[2:3] if toxic else PLAIN[1::2])
        rows.append((i, f"{text} {rng.choice('abcdefgh') * 4}", int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return docs.select("doc_id", "text"), docs.select("doc_id", F.lit(1).alias("quality"), "toxic")


def test_counterfactuals_free_neutral_mentions(spark):
    docs, labels = biased(spark)
    sample = TX.training_sample(docs, labels)
    mentions = [t.format(g) for t in NEUTRAL for g in ("muslim", "christian", "jewish", "hindu")]
    probe = spark.createDataFrame(list(enumerate(mentions)), "doc_id long, text string")

    def spread(model):
        got = {r.doc_id: r.score for r in TX.score_texts(probe, model).collect()}
        return max(max(got[i * 4 + k] for k in range(4)) - min(got[i * 4 + k] for k in range(4)) for i in range(3)), max(got.values())

    plain, regular = spread(TX.fit(sample, counterfactual=0)), spread(TX.fit(sample, counterfactual=20.0))
    assert regular[0] < plain[0] / 3 and regular[1] < plain[1]
    hostile = spark.createDataFrame([(0, "you jewish idiot get lost"), (1, "stupid scum everywhere")], "doc_id long, text string")
    assert all(r.predicted for r in TX.score_texts(hostile, TX.fit(sample, counterfactual=20.0)).collect())


def test_swaps():
    terms = (("muslim", "christian", "jewish"), ("man", "woman"))
    assert TX.swaps_of("A Muslim man!", terms) == ["a christian woman ", "a jewish man "]
    assert TX.swaps_of("nobody here", terms) == []


def test_training_takes_no_held_out_row_and_is_bounded(spark, documents, labels):
    more = labels.unionByName(labels.withColumn("toxic", F.lit(0))).unionByName(spark.createDataFrame([(None, 1, 1)], labels.schema))
    sample = TX.training_sample(documents, more, rows=20).collect()
    assert len(sample) == 20
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in sample)
    toxic = {r.doc_id for r in labels.collect() if r.toxic}
    assert all(r.toxic == (r.doc_id in toxic) for r in sample)


def test_toxicity_awkward(awkward, empty, labels):
    got = TX.toxicity(awkward, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in awkward.collect())
    assert all(0 <= r.score <= 1 for r in got.collect())
    assert TX.toxicity(empty, labels).collect() == []
    assert TX.toxicity(awkward, labels.limit(0)).count() == awkward.count()
    assert TX.without_toxic(awkward, labels).columns == awkward.columns


# line dedup


def line_dedup_by_hand(rows, min_sites, min_words, max_share, evidence=None):
    space = " \t\n\x0b\f\r"

    def key(line):
        return line.strip(space) if len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= min_words else None

    sites = defaultdict(set)
    for _, text, site in rows if evidence is None else evidence:
        for line in text.split("\n"):
            if key(line) is not None:
                sites[key(line)].add(site)
    common = {k for k, v in sites.items() if len(v) >= min_sites}
    out = Counter()
    for doc_id, text, _ in rows:
        lines = text.split("\n")
        left = [x for x in lines if key(x) not in common]
        total, kept = sum(map(len, lines)), sum(map(len, left))
        gone, page = len(lines) - len(left), total - kept <= max_share * total
        out[doc_id, len(lines), gone, gone if page else 0, "\n".join(left) if page else text] += 1
    return out


@pytest.mark.parametrize(("min_sites", "min_words", "max_share"), [(5, 3, 0.5), (2, 1, 1.0), (12, 3, 0.3)])
def test_line_dedup(documents, awkward, min_sites, min_words, max_share):
    docs = documents.select("doc_id", "text", "source").unionByName(awkward.select("doc_id", "text", "source"))
    rows = [(r.doc_id, r.text or "", r.source or "") for r in docs.collect()]
    got = LD.line_dedup(docs, min_sites, min_words, max_share).collect()
    assert Counter(map(tuple, got)) == line_dedup_by_hand(rows, min_sites, min_words, max_share)


def test_spread_counts_sites_not_copies(spark):
    """Near the threshold sites are counted exactly; many copies on few sites are no spread."""
    rows = [(n * 10_000 + i, f"s{i % n}", n) for n in range(35, 66) for i in range(3 * n)]
    lines = spark.createDataFrame(rows, "doc_id long, site string, line long")
    got = {r.line for r in LD.boilerplate_lines(lines, min_sites=50, near=0.2, log_k=8).collect()}
    assert got == set(range(50, 66))


def test_line_dedup_keeps_columns_and_untouched_rows(awkward, empty):
    out = LD.without_boilerplate(awkward, min_sites=2, min_words=1, max_share=1.0)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    null = [r for r in out.collect() if r.doc_id == 1]
    assert null[0].text is None
    same = [r for r in out.collect() if r.doc_id == 6]
    assert [(r.text, r.n_chars) for r in same] == [("", 0)] * 2
    assert LD.without_boilerplate(empty).collect() == LD.line_dedup(empty).collect() == []


NAVIGATION = "Accept all cookies to go on\nRead our full privacy policy here\nSubscribe to the newsletter of this site today"


def test_pages_that_are_mostly_boilerplate_lose_it(spark):
    """Pages with over half of their text in shared lines lose those; whole copies only where they are asked to stay."""
    pages = [(i, f"{NAVIGATION}\nPage number {i} has little else", f"s{i % 6}") for i in range(12)]
    copies = [(100 + i, f"A story that six sites print as it is\n{' '.join(map(str, range(60)))}", f"s{i}") for i in range(6)]
    one_line = [(200 + i, " ".join(f"word{k}" for k in range(60)), f"s{i}") for i in range(6)]
    docs = spark.createDataFrame(pages + copies + one_line, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in LD.line_dedup(docs).collect()}
    assert {i: got[i].text for i, _, _ in pages} == {i: f"Page number {i} has little else" for i, _, _ in pages}
    assert all(r.n_removed == r.n_boilerplate > 0 for r in got.values())
    assert {got[i].text for i, _, _ in copies + one_line} == {""}
    spared = {r.doc_id: r.text for r in LD.without_boilerplate(docs, evidence=ND.one_of_each_class(docs)).collect()}
    assert spared == {i: got[i].text for i, _, _ in pages} | {i: t for i, t, _ in copies + one_line}


def test_short_lines_and_scripts_without_spaces_are_judged(spark):
    common = ["Privacy policy", "  Sign in\t", "本网站使用cookies来改善您的浏览体验", "ข้อกำหนดและเงื่อนไข"]
    rows = [(i, "\n".join([*common, f"own{i}", "", "Two sites" if i < 2 else "x y"]), f"s{i}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.n_removed, r.text) for r in LD.line_dedup(docs).collect()}
    # what is on two or three sites stays, blank lines too
    assert got == {i: (4, f"own{i}\n\n" + ("Two sites" if i < 2 else "x y")) for i in range(5)}


# near dedup

WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")


def words_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text)]


def shingles_of(text, size=5):
    w = words_of(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else Counter([tuple(w)])


def classes_by_hand(rows, threshold=0.8, min_share=0.0):
    sets = [shingles_of(t) for _, t in rows]
    df = Counter(k for s in sets for k in s)
    weight = {k: 1 - math.log(max(n / len(rows), min_share)) for k, n in df.items()}
    total = [sum(weight[k] * n for k, n in s.items()) for s in sets]
    inside = defaultdict(list)
    for i, s in enumerate(sets):
        for k in s:
            inside[k].append(i)
    both = defaultdict(float)
    for k, at in inside.items():
        for x, i in enumerate(at):
            for j in at[x + 1 :]:
                both[i, j] += weight[k] * min(sets[i][k], sets[j][k])
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    first = {}
    links = [(i, j) for (i, j), v in both.items() if v >= threshold * (total[i] + total[j] - v) - 1e-9]
    links += [(first.setdefault(t, i), i) for i, (_, t) in enumerate(rows)]
    for i, j in links:
        parent[max(find(i), find(j))] = min(find(i), find(j))
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    return Counter(
        (rows[i][0], min((x for x in members[find(i)] if x is not None), default=None), len(members[find(i)])) for i in range(len(rows))
    )


def test_shingles_equal_brute_force():
    texts = ["", "One two THREE four five six one two three four five", "a b", "ab", "É é x y z w v", "  ...  ", "a b c d e"] + [
        " ".join(random.Random(i).choices("abc", k=i)) for i in range(30)
    ]
    hashes, n = word_hashes(pa.array(texts))
    assert n.tolist() == [len(words_of(t)) for t in texts]
    names = {}
    for w, h in zip((w for t in texts for w in words_of(t)), hashes.tolist(), strict=True):
        assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)
    text, keys, counts = shingles(pa.array(["skip me", *texts]).slice(1))
    for i, t in enumerate(texts):
        assert sorted(counts[text == i].tolist()) == sorted(shingles_of(t).values())
    known = {}
    for i, t in enumerate(texts):
        for k in keys[text == i].tolist():
            known.setdefault(k, set()).add(i)
    by_hand = defaultdict(set)
    for i, t in enumerate(texts):
        for s in shingles_of(t):
            by_hand[s].add(i)
    assert sorted(map(sorted, known.values())) == sorted(map(sorted, by_hand.values()))


def test_samples_agree_as_often_as_the_weighted_jaccard_says():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 52, 300).astype(np.uint64))
    a, b = rng.uniform(0.5, 4, len(keys)), rng.uniform(0.5, 4, len(keys))
    b[:100] = a[:100]
    text, samples = ND.weighted_samples(np.repeat([0, 1], len(keys)), np.tile(keys, 2), np.concatenate((a, b)), 4000)
    agree = (samples[0] == samples[1]).mean()
    assert text.tolist() == [0, 1]
    assert abs(agree - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03


def test_near_dedup(documents, awkward):
    docs = documents.select("doc_id", "text").unionByName(awkward.select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    got = ND.near_dedup(docs).collect()
    assert Counter(tuple(r)[:3] for r in got) == classes_by_hand(texts_of(docs))
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def edited(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**9)}"
    return out


def test_groups_on_both_sides_of_the_threshold(spark, monkeypatch):
    """A group of copies whose similarities lie around the threshold, more than a block of them, and
    a passage that many unlike texts share: classes are those of all pairs."""
    monkeypatch.setattr(ND, "BLOCK", 16)
    rng = random.Random(11)
    base = [f"v{rng.randrange(5000)}" for _ in range(150)]
    passage = [f"p{i}" for i in range(60)]
    rows = [" ".join(edited(base, rng.randrange(8), rng)) for _ in range(120)]
    rows += [" ".join(passage + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(20, 120))]) for _ in range(80)]
    rows += [" ".join(base)] * 40
    chain = list(base[:100])
    for i in range(0, 60, 2):
        chain[i] = f"c{i}"
        rows.append(" ".join(chain))
    rng.shuffle(rows)
    rows = [(i, t) for i, t in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # the weights follow the counts, and the classes the weights
    got = Counter(tuple(r)[:3] for r in ND.near_dedup(docs, bands=40, rows=3).collect())
    assert got == classes_by_hand(rows)


def test_pages_with_a_common_passage_stay(spark):
    """Thirty of a thousand pages are a passage of a hundred words and eight of their own: the passage is
    frequent enough to weigh less. Eight pages that differ in one word of two hundred are one class."""
    rng = random.Random(21)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    passage, story = fresh(100), fresh(200)
    rows = [" ".join(passage + fresh(8)) for _ in range(30)] + [" ".join(story[:i] + fresh(1) + story[i + 1 :]) for i in range(0, 160, 20)]
    rows += [" ".join(fresh(60)) for _ in range(1000 - len(rows))]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    kept = {r.doc_id for r in ND.one_of_each_class(docs).collect()}
    assert set(range(1000)) - kept == set(range(31, 38))


def test_near_dedup_keeps_one_row_and_all_columns(awkward, empty):
    kept = ND.one_of_each_class(awkward)
    assert kept.columns == awkward.columns
    rows = kept.select("doc_id", "text").collect()
    assert {r.doc_id for r in rows} == {c for _, c, _ in classes_by_hand(texts_of(awkward))}
    assert len(rows) == len({r.text or "" for r in rows})
    assert ND.one_of_each_class(empty).collect() == ND.near_dedup(empty).collect() == []


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (1, "one two three four five six"), (2, "one two three four five six")], "doc_id long, text string")
    assert [tuple(r) for r in ND.one_of_each_class(docs).collect()] == [(1, "one two three four five six")]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 50), (300, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 50, 200: 50, 50: 50}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# pipeline


def test_pipeline_stages(spark):
    """Each stage on its own input: what goes, what stays, and the columns."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, seen = docs.columns, []
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, "/root/testdata/sf0.001"), name)
        seen.append(name)
        before, after = texts_of(docs), None
        if name != "packing":
            assert out.columns == columns
            after = texts_of(out)
            assert {i for i, _ in after} <= {i for i, _ in before}
        if name in ("toxicity", "quality", "near_dedup"):
            assert set(after) <= set(before)
        if name == "line_dedup":
            rows = [(r.doc_id, r.text or "", r.source or "") for r in docs.collect()]
            firsts = {c for _, c, _ in classes_by_hand(before, corpus_pipeline.COPY_SIMILARITY)}
            want = line_dedup_by_hand(rows, LD.MIN_SITES, LD.MIN_WORDS, LD.MAX_SHARE, [r for r in rows if r[0] in firsts])
            assert Counter(after) == Counter({(k[0], k[4]): n for k, n in want.items()})
        if name == "near_dedup":
            assert {i for i, _ in after} == {c for _, c, _ in classes_by_hand(before)}
        if name == "packing":
            assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in out.collect())
            assert {r.doc_id for r in out.collect()} == {i for i, _ in before}
        docs = out
    assert seen == ["toxicity", "quality", "line_dedup", "near_dedup", "packing"]
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() == docs.count()


@pytest.mark.parametrize("whole_line", [True, False])
def test_copies_on_many_sites_leave_a_whole_text(spark, whole_line):
    """Six copies of a text on six sites, another line changed in each, beside pages with navigation."""
    rng = random.Random(8)
    lines = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) for _ in range(20)]
    changed = [f"changed in {i} alone" if whole_line else f"{lines[i]} changed{i}" for i in range(6)]
    copies = [(i, "\n".join(lines[:i] + [changed[i]] + lines[i + 1 :]), f"s{i}") for i in range(6)]
    pages = [(100 + i, NAVIGATION + "\n" + " ".join(f"p{i}x{k}" for k in range(40)), f"s{i}") for i in range(6)]
    docs = spark.createDataFrame(copies + pages, "doc_id long, text string, source string")
    stages = dict(corpus_pipeline.STAGES)
    cleaned = stage(stages["line_dedup"](spark, docs, ""), "lines")
    assert {r.doc_id: r.text for r in cleaned.collect()} == {i: t for i, t, _ in copies} | {i: t.split("\n")[-1] for i, t, _ in pages}
    left = {r.doc_id: r.text for r in stages["near_dedup"](spark, cleaned, "").collect()}
    assert left[0] == copies[0][1] and set(left) - set(range(6 if whole_line else 1)) == {i for i, _, _ in pages}


def test_stages_of_awkward_and_empty_tables(spark, awkward, empty, tmp_path):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (awkward, empty):
        ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
        for name, step in corpus_pipeline.STAGES:
            out = stage(step(spark, docs, str(tmp_path)), name)
            if name == "packing":
                assert {r.doc_id for r in out.collect()} == set(ids)
            else:
                assert out.columns == docs.columns
                assert not Counter(r.doc_id for r in out.collect()) - ids
