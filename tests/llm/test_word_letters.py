"""Words of letters, whose ids are asked of the merge model directly, against the whole library."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from qalam.llm import word_ids as W

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return W.WordEncoder(PATH)


def test_shortcut_is_taken_for_this_file_alone(tmp_path, encoder):
    assert encoder.model is not None
    text = open(PATH, encoding="utf-8").read()
    for old, new in (('"Lowercase"', '"NFKC"'), ('"invert":true', '"invert":false'), ('"add_prefix_space":false', '"add_prefix_space":true')):
        text = text.replace(": ", ":") if old not in text else text
        other = tmp_path / "other.json"
        other.write_text(text.replace(old, new, 1), encoding="utf-8")
        assert text.replace(old, new, 1) != text and not W.lowers_whole_words(str(other))


def test_letters(encoder):
    """Every letter of the class alone and in random words, in both cases, and words just outside it."""
    library, rng = Tokenizer.from_file(PATH), random.Random(1)
    letters = [c for c in map(chr, range(0x250)) if W.LETTERS.fullmatch(c)]
    assert len(letters) == 52 + 62 and "×" not in letters and "÷" not in letters
    words = letters + ["".join(rng.choices(letters, k=rng.randrange(1, 20))) for _ in range(3000)]
    words += [w + x for w in words[:200] for x in ("'s", "́", "1", ".", "ı", "İ", "µ")]
    texts = pa.array([" ".join(words), "", *words[:300]])
    flat, lengths = encoder.encode(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    assert lengths.tolist() == [len(x) for x in want] and flat.tolist() == [i for x in want for i in x]


def test_older_half_is_forgotten(encoder, monkeypatch):
    monkeypatch.setattr(W, "MAX_CACHED_WORDS", 10)
    one = W.WordEncoder(PATH)
    for k in range(8):
        words = [f"word{'abcdefgh'[k]}{'xyzuvw'[i]}" for i in range(6)]
        assert one.encode(pa.array([" ".join(words)]))[0].tolist() == encoder.encode(pa.array([" ".join(words)]))[0].tolist()
        assert len(one.known) <= 10 + 6
