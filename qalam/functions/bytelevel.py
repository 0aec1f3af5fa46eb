"""Byte-level BPE helpers (pure Python, used inside Arrow batches).

The pre-tokeniser pattern and the byte->character table are the public GPT-2 byte-level
conventions; the table is built from its rule, not listed.
"""

from __future__ import annotations

from functools import lru_cache

import regex

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference tokenizer's behaviour)
#   byte-level pre-tokenisation pattern (no prefix space added)
PRETOKEN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#   special tokens in id order 0..5
SPECIAL_TOKENS = ["<pad>", "<s>", "</s>", "<unk>", "<2ar>", "<2en>"]
PAD_ID, BOS_ID, EOS_ID, UNK_ID, TAG_AR_ID, TAG_EN_ID = range(6)
# ---------------------------------------------------------------------------------------------

_PRETOKEN_RE = regex.compile(PRETOKEN_PATTERN)
_SPECIAL_RE = regex.compile("|".join(regex.escape(t) for t in SPECIAL_TOKENS))


@lru_cache(maxsize=1)
def byte_to_char() -> dict[int, str]:
    """Printable bytes map to themselves; the other 68 bytes map to U+0100.. in byte order."""
    keep = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    table = {b: chr(b) for b in keep}
    extra = 0
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + extra)
            extra += 1
    return table


@lru_cache(maxsize=1)
def char_to_byte() -> dict[str, int]:
    return {c: b for b, c in byte_to_char().items()}


def alphabet() -> list[str]:
    """The 256 byte symbols in code-point order (their ids follow the special tokens)."""
    return sorted(byte_to_char().values())


@lru_cache(maxsize=1)
def _latin1_to_symbol() -> dict[int, str]:
    """``str.translate`` table: a byte read as a Latin-1 code point -> its byte symbol."""
    return dict(byte_to_char())


def _symbols(piece: str) -> str:
    return piece.encode("utf-8").decode("latin-1").translate(_latin1_to_symbol())


def pretokenize(text: str) -> list[str]:
    """Split with the byte-level pattern and map each piece's UTF-8 bytes to symbols."""
    return [_symbols(piece) for piece in _PRETOKEN_RE.findall(text)]


def iter_pretokens(text: str):
    """Lazy :func:`pretokenize` (same scan), so an encoder can stop at its length limit."""
    for m in _PRETOKEN_RE.finditer(text):
        yield _symbols(m.group(0))


def split_specials(text: str) -> list[tuple[bool, str]]:
    """Split out special tokens (matched literally anywhere) -> [(is_special, segment)]."""
    out: list[tuple[bool, str]] = []
    pos = 0
    for m in _SPECIAL_RE.finditer(text):
        if m.start() > pos:
            out.append((False, text[pos : m.start()]))
        out.append((True, m.group(0)))
        pos = m.end()
    if pos < len(text):
        out.append((False, text[pos:]))
    return out


def decode_symbols(tokens: list[str]) -> str:
    c2b = char_to_byte()
    data = bytearray()
    for t in tokens:
        for ch in t:
            b = c2b.get(ch)
            if b is None:
                data.extend(ch.encode("utf-8"))
            else:
                data.append(b)
    return data.decode("utf-8", errors="replace")


class BPEEncoder:
    """Apply ranked merges to pre-tokenised words (lowest rank first, left to right)."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], cache_size: int = 200_000):
        self.vocab = vocab
        self.ranks = {pair: i for i, pair in enumerate(merges)}
        self.special = {t: vocab[t] for t in SPECIAL_TOKENS if t in vocab}
        self.unk = vocab.get("<unk>", UNK_ID)
        self.cache: dict[str, list[int]] = {}
        self.cache_size = cache_size

    def word_ids(self, word: str) -> list[int]:
        hit = self.cache.get(word)
        if hit is not None:
            return hit
        syms = list(word)
        ranks = self.ranks
        while len(syms) > 1:
            best, best_rank = None, None
            for i in range(len(syms) - 1):
                r = ranks.get((syms[i], syms[i + 1]))
                if r is not None and (best_rank is None or r < best_rank):
                    best, best_rank = (syms[i], syms[i + 1]), r
            if best is None:
                break
            merged, i = [], 0
            while i < len(syms):
                if i < len(syms) - 1 and syms[i] == best[0] and syms[i + 1] == best[1]:
                    merged.append(syms[i] + syms[i + 1])
                    i += 2
                else:
                    merged.append(syms[i])
                    i += 1
            syms = merged
        ids = [self.vocab.get(s, self.unk) for s in syms]
        if len(self.cache) >= self.cache_size:
            self.cache.clear()
        self.cache[word] = ids
        return ids

    def piece_ids(self, piece: str) -> list[int]:
        """Ids of a special token or of one pre-tokenised word, in plain text."""
        special = self.special.get(piece)
        return [special] if special is not None else self.word_ids(_symbols(piece))

    def encode(self, text: str, max_length: int | None = None) -> list[int]:
        """Token ids of ``text``, truncated to ``max_length``. Ids of a prefix never depend on
        later words, so encoding stops once the limit is reached."""
        ids: list[int] = []
        for is_special, seg in split_specials(text or ""):
            if max_length is not None and len(ids) >= max_length:
                break
            if is_special:
                ids.append(self.special[seg])
            else:
                for w in iter_pretokens(seg):
                    ids.extend(self.word_ids(w))
                    if max_length is not None and len(ids) >= max_length:
                        break
        return ids[:max_length] if max_length is not None else ids
