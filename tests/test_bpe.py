"""BPE: batched distributed training equals one-at-a-time BPE (the tokenizers trainer)."""

import pytest

from qalam.functions.bytelevel import SPECIAL_TOKENS, pretokenize
from qalam.operators.bpe import pretoken_counts, select_batch, train_bpe

tokenizers = pytest.importorskip("tokenizers")


def hf_train(texts, vocab_size):
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

    tok = Tokenizer(models.BPE(unk_token="<unk>"))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    trainer = trainers.BpeTrainer(
        vocab_size=vocab_size,
        special_tokens=SPECIAL_TOKENS,
        min_frequency=2,
        initial_alphabet=pre_tokenizers.ByteLevel.alphabet(),
        show_progress=False,
    )
    tok.train_from_iterator(iter(texts), trainer=trainer)
    return tok


def test_fixture_merges(spark):
    texts = ["<2ar> zq zq"] * 5
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    model = train_bpe(pretoken_counts(df, ["t"]), vocab_size=265)
    assert model.merges == [("z", "q"), ("Ġ", "zq"), ("a", "r")]
    assert model.encoder().encode("<2ar> zq") == [4, 263]


def test_matches_library_trainer(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(40).collect()
    texts = ["<2ar> " + r[0][:3000] for r in rows]
    hf = hf_train(texts, 700)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    model = train_bpe(pretoken_counts(df, ["t"]), vocab_size=700, top_k=64)
    hv = hf.get_vocab()
    assert len(model.tokens) == hf.get_vocab_size()
    assert all(hv[t] == i for i, t in enumerate(model.tokens))
    enc = model.encoder()
    for t in texts[:10] + ["<2en> مرحبا بالعالم", "plain text, with 123 numbers!"]:
        assert enc.encode(t) == hf.encode(t).ids


def test_pretokenize_matches_library():
    from tokenizers import pre_tokenizers

    pt = pre_tokenizers.ByteLevel(add_prefix_space=False)
    for t in ["Hello world's  end\n\n x", "مرحبا 123abc", "  lead", "a--b  ", "tab\there"]:
        assert pretokenize(t) == [w for w, _ in pt.pre_tokenize_str(t)]


def test_pretoken_counts_match_python(spark):
    """The Java pattern and the built-in byte symbols against the Python ones, for odd white space too."""
    import random
    from collections import Counter

    rng = random.Random(2)
    pool = "aZé م12٣½ '’sdtlvemr!?.  \n\n\t\r\x0b\x0c\x1c\x1f\x85\u00a0\u2028\u3000\u200b\u0301\U0001f600\x00日本"
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(30))) for _ in range(800)] + ["", None, "  x", "x  ", "a" * 50_000, " " * 50_000]
    df = spark.createDataFrame([(t, "it's") for t in texts], "t string, u string")
    got = {r.word: r.n for r in pretoken_counts(df, ["t", "u"]).collect()}
    want = Counter(w for t in texts for w in pretokenize(t or "")) + Counter(pretokenize("it's") * len(texts))
    assert got == want
    plan = pretoken_counts(df, ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


def test_select_batch_rules():
    # inputs are exact top lists: count desc, then ids asc
    # (2, 5) chains with (1, 2) (its left is the merged right symbol): its count is stale -> stop
    top = [(1, 2, 10), (3, 4, 9), (2, 5, 8), (6, 7, 8)]
    assert select_batch(top, 2, 100) == [(1, 2, 10), (3, 4, 9)]
    # (7, 1) chains with (1, 2) from the other side
    top = [(1, 2, 10), (3, 4, 9), (7, 1, 9), (5, 6, 8)]
    assert select_batch(top, 2, 100) == [(1, 2, 10), (3, 4, 9)]
    # pairs that only share a symbol without chaining occupy disjoint positions: accepted,
    # ties included
    top = [(1, 2, 10), (1, 3, 9), (4, 2, 9), (5, 6, 9), (2, 8, 9)]
    assert select_batch(top, 2, 100) == [(1, 2, 10), (1, 3, 9), (4, 2, 9), (5, 6, 9)]
    # a self pair ends the batch (first or later)
    assert select_batch([(1, 1, 10), (3, 4, 9)], 2, 100) == [(1, 1, 10)]
    assert select_batch([(3, 4, 10), (1, 1, 9), (5, 6, 8)], 2, 100) == [(3, 4, 10), (1, 1, 9)]
    # min frequency and room
    assert select_batch([(1, 2, 1)], 2, 100) == []
    assert select_batch([(1, 2, 5), (3, 4, 2), (5, 6, 1)], 2, 100) == [(1, 2, 5), (3, 4, 2)]
    assert select_batch([(1, 2, 5), (3, 4, 4)], 2, 1) == [(1, 2, 5)]


@pytest.mark.parametrize(("size", "top_k", "held_words"), [(360, 300, 0), (700, 300, 2500), (3000, 2000, 100_000), (12_000, 20_000, 100_000)])
def test_matches_library_trainer_many_rounds(spark, size, top_k, held_words):
    """Whole sf0.001 documents, by batches in the tasks alone, with versions that end where no more words
    fit, with versions that end at the floor, and until no pair is left: same vocabulary ids and
    encodings as the library."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").orderBy("doc_id").collect()
    texts = ["<2ar> " + r[0] for r in rows]
    hf = hf_train(texts, size)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    model = train_bpe(pretoken_counts(df, ["t"]), vocab_size=size, top_k=top_k, held_words=held_words)
    hv = hf.get_vocab()
    assert len(model.tokens) == hf.get_vocab_size()
    assert all(hv[t] == i for i, t in enumerate(model.tokens))
    enc = model.encoder()
    for t in texts[:20]:
        assert enc.encode(t) == hf.encode(t).ids


@pytest.mark.parametrize("held_words", [0, 100_000])
def test_long_words_and_runs(spark, held_words):
    """Long words of few letters, runs of one letter among them: the library's merges."""
    import random

    rng = random.Random(4)
    texts = ["".join(rng.choices("abc", k=n)) for n in (2, 3, 50, 400, 1200)] + ["a" * n for n in (2, 3, 4, 5, 17, 300)] + ["aab" * 60, "baa" * 41]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    model = train_bpe(pretoken_counts(df, ["t"]), vocab_size=330, held_words=held_words)
    hv = hf_train(texts, 330).get_vocab()
    assert {t: i for i, t in enumerate(model.tokens)} == hv


def test_truncated_encoding_is_prefix_of_full(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").orderBy("doc_id").limit(30).collect()
    texts = ["<2ar> " + r[0] for r in rows]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    enc = train_bpe(pretoken_counts(df, ["t"]), vocab_size=320).encoder()
    probes = texts + ["a <2en> b <pad> c " * 40, "<2ar>", "", "x" * 500]
    for t in probes:
        full = enc.encode(t)
        for k in (0, 1, 5, 16, 128):
            assert enc.encode(t, k) == full[:k]


def test_special_token_audit_checks_every_row(spark):
    from qalam.operators.encode import encode_pairs, special_token_audit

    texts = ["<2ar> zq zq"] * 5 + ["<2en> qz"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    model = train_bpe(pretoken_counts(df, ["t"]), vocab_size=265)
    rows = spark.createDataFrame(
        [(1, "en_to_ar", "<2ar> zq", "x"), (2, "ar_to_en", "<2en> qz", "y"), (3, "ar_to_en", "no tag", "z")],
        "row_id long, direction string, source_text string, target_text string",
    )
    out = {r["token"]: r for r in special_token_audit(spark, model, encode_pairs(rows, model)).collect()}
    assert [out[t]["id"] for t in SPECIAL_TOKENS] == list(range(6))
    assert (out["<2ar>"]["tagged_rows"], out["<2ar>"]["tag_first_rows"]) == (1, 1)
    assert (out["<2en>"]["tagged_rows"], out["<2en>"]["tag_first_rows"]) == (2, 1)
    assert out["<pad>"]["tagged_rows"] == 0


def test_columnar_encoding_equals_text_by_text(spark):
    """Pieces cut by built-ins and gathered by numpy against the row encoder: special tokens anywhere, odd
    white space, nulls, empty and long texts, every limit; then back to text."""
    import random

    from qalam.operators.encode import decode_ids, encode_pairs, token_lengths

    rng = random.Random(6)
    pool = ["aé ", "م12", "½'s", "  ", "\n\n", "\t", "  ", "日本\U0001f600", "!?", "the", " the", *SPECIAL_TOKENS, "<", ">", "<2a", "2en>", "\x00\x85"]
    texts = ["".join(rng.choices(pool, k=rng.randrange(30))) for _ in range(400)] + ["", None, "<2ar>", " <s> ", "x" * 3000, "the " * 3000]
    df = spark.createDataFrame([(i, t, texts[-1 - i]) for i, t in enumerate(texts)], "row_id long, source_text string, target_text string")
    model = train_bpe(pretoken_counts(df, ["source_text"]), vocab_size=330)
    enc = model.encoder()
    for limit in (None, 0, 1, 7, 128):
        for r in encode_pairs(df, model, limit, keep=["row_id"]).collect():
            want = enc.encode(texts[r.row_id] or "", limit), enc.encode(texts[-1 - r.row_id] or "", limit)
            assert (r.input_ids, r.labels) == want and r.attention_mask == [1] * len(want[0])
    lengths = {r.row_id: (r.source_text_len, r.source_text_unk) for r in token_lengths(df, model, ["source_text"]).collect()}
    assert lengths == {i: (len(enc.encode(t or "")), 0) for i, t in enumerate(texts) if "<unk>" not in (t or "")} | {
        i: (len(enc.encode(t)), t.count("<unk>")) for i, t in enumerate(texts) if "<unk>" in (t or "")
    }
    back = decode_ids(encode_pairs(df, model, None, keep=["row_id"]), model, ["input_ids", "labels"])
    assert {r.row_id: r.decoded_input_ids for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}
    plain = decode_ids(encode_pairs(df.where("row_id < 50"), model, None, keep=["row_id"]), model, ["input_ids"], skip_special=True)
    for r in plain.collect():
        want = texts[r.row_id]
        for t in SPECIAL_TOKENS:
            want = want.replace(t, "")
        assert "<2ar>" in (texts[r.row_id]) or r.decoded_input_ids == want


@pytest.mark.parametrize(("held_words", "rounds"), [(300, 60), (20_000, 8)])
def test_versions_do_not_grow_with_the_words(spark, held_words, rounds):
    """Many distinct words share few stretches of frequent pairs: the library's merges from a few versions,
    ties and runs of one letter among them, though the words themselves are far more than are held."""
    import random

    rng = random.Random(8)
    syllables = ["".join(rng.choices("abcdeo", k=k)) for k in (1, 2, 2, 3, 3, 3, 4) for _ in range(12)] + ["aaa", "bb"]
    texts = ["".join(rng.choices(syllables, k=rng.randrange(1, 7))) for _ in range(30_000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    model = train_bpe(pretoken_counts(df, ["t"]), vocab_size=1200, held_words=held_words)
    assert {t: i for i, t in enumerate(model.tokens)} == hf_train(texts, 1200).get_vocab()
    assert model.rounds <= rounds


def test_texts_are_cut_and_segmented_without_code_per_word(spark, monkeypatch):
    """Pieces of whole columns by numpy against the pattern, words against the word encoder: runs of one
    letter, strings that are no tokens, and a memory that holds few words."""
    import random

    import numpy as np
    import pyarrow as pa

    from qalam.functions import columnar
    from qalam.functions.bytelevel import BPEEncoder, split_specials
    from qalam.operators.encode import encode_pairs

    kinds = np.frombuffer(columnar.char_kinds(spark), np.uint8)
    rng = random.Random(11)
    pool = ["a", "Z", "é", " ", " ", "  ", "\n", "\t", "\u3000", "'", "'", "s", "re", "l", "l", "d", "١", "7", "½", "!", "日", "\U0001f600", "\x00", "<s>", "<2ar>", "<", ">"]
    texts = ["".join(rng.choices(pool, k=rng.randrange(16))) for _ in range(4000)] + ["", " ", "'", "'s", "<s>", " <s> "]
    pieces, bounds = columnar.cut(pa.array(texts, pa.large_string()).slice(3), kinds)
    found = pieces.to_pylist()
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, a, b in zip(texts[3:], bounds[:-1], bounds[1:], strict=True):
        want = [x for special, part in split_specials(t) for x in ([part] if special else pattern_pieces(part))]
        assert found[a:b] == want, t
    assert len(columnar.cut(pa.array([], pa.large_string()), kinds)[0]) == 0

    merges = [("a", "a"), ("aa", "aa"), ("b", "a"), ("aa", "b"), ("Ġ", "b"), ("aa", "c")]
    tokens = [*SPECIAL_TOKENS, "a", "b", "Ġ", "aa", "aaaa", "ba", "aab", "Ġb"]
    row = BPEEncoder({t: i for i, t in enumerate(tokens)}, merges)
    monkeypatch.setattr(columnar, "MAX_CACHED_WORDS", 50)
    enc = columnar.Segmenter(tokens, merges)
    for _ in range(6):
        words = list({"".join(rng.choices("aaabc ", k=rng.randrange(1, 12))) for _ in range(60)} | {"<s>", "", "é", "a" * 101})
        starts, sizes, flat = enc.distinct(pa.array(words, pa.large_string()))
        assert [flat[s : s + n].tolist() for s, n in zip(starts, sizes, strict=True)] == [row.piece_ids(w) for w in words]
        assert len(enc.words) <= 110 and enc.words.slice(0, 6).to_pylist() == SPECIAL_TOKENS

    model = train_bpe(pretoken_counts(df, ["t"]), vocab_size=265)
    plan = encode_pairs(df, model, 128, "t", "t", keep=[])._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan


def pattern_pieces(text):
    from qalam.functions.bytelevel import _PRETOKEN_RE

    return _PRETOKEN_RE.findall(text)


def test_words_are_filtered_after_they_are_counted(spark):
    """The filter on words of one symbol is not pushed below the counts, where it would make the symbols of
    every place; words that are null or empty are left out too."""
    words = spark.createDataFrame([("ab", 5), ("abab", 4), ("a", 9), ("", 3), (None, 2)], "word string, n long")
    assert train_bpe(words, vocab_size=264).merges == [("a", "b"), ("ab", "ab")]
    seen = []
    real = type(words).repartition
    df = pretoken_counts(spark.createDataFrame([("ab ab",)], "t string"), ["t"])
    try:
        type(words).repartition = lambda self, *a: seen.append(self) or real(self, *a)
        train_bpe(df, vocab_size=263)
    finally:
        type(words).repartition = real
    assert "Filter" not in seen[0]._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[1]


def test_decoding_gives_back_what_is_kept(spark):
    """Whole texts by their buffers, cut characters with a replacement, null and empty rows, label padding;
    of the other columns those that are kept, and only those reach the tasks."""
    from qalam.operators.encode import _decoder, decode_ids, encode_pairs

    import pyarrow as pa

    texts = ["é日 x", "", "a\U0001f600", "plain"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, t string")
    model = train_bpe(pretoken_counts(df, ["t"]), vocab_size=262)
    ids = encode_pairs(df, model, None, "t", "t", keep=["row_id"])
    out = decode_ids(ids, model, ["input_ids", "labels"], keep=["row_id"])
    assert out.columns == ["row_id", "decoded_input_ids", "decoded_labels"]
    assert {r.row_id: (r[1], r[2]) for r in out.collect()} == {i: (t, t) for i, t in enumerate(texts)}
    assert "attention_mask" not in out._jdf.queryExecution().optimizedPlan().toString().split("Project [")[1].split("]")[0]

    decode, enc = _decoder(model.tokens, 0), model.encoder()
    rows = [enc.encode("é日"), None, [], [-100, *enc.encode("x"), -100], enc.encode("日")[:2], enc.encode("日")[2:]]
    type_ = pa.list_(pa.int32())
    assert decode(pa.array(rows[:4], type_)).to_pylist() == ["é日", None, "", "x"]
    assert decode(pa.array(rows, type_).slice(1)).to_pylist() == [None, "", "x", "\ufffd", "\ufffd"]
    assert decode(pa.array([], type_)).to_pylist() == []
