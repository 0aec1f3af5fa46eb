"""n-gram statistics of rows for corpus BLEU and chrF, a whole Arrow batch at a time.

Only per-row *statistics* are computed here; the corpus scores are sums of these statistics
followed by a closed form evaluated as Spark expressions (never an average of row scores).

An n-gram is a number: its units' numbers side by side, or its rank among all n-grams of the slice where
those take too many bits. Row, n-gram and side (hypothesis or reference) make one 64-bit key; sorted keys
bring equal n-grams of a row together, and the smaller of the two sides' counts is the clipped match. All
of it is exact, and no Python code runs per row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the public "13a" tokenizer of the BLEU reference implementation)
#   pre-replacements: "<skipped>" -> "", "-\n" -> "", "\n" -> " ",
#                     "&quot;" -> '"', "&amp;" -> "&", "&lt;" -> "<", "&gt;" -> ">"
#   then, in order:
#     ([\{-\~\[-\` -\&\(-\+\:-\@\/])  ->  " \1 "     (symbols)
#     ([^0-9])([\.,])                 ->  "\1 \2 "   (period/comma not after a digit)
#     ([\.,])([^0-9])                 ->  " \1 \2"   (period/comma not before a digit)
#     ([0-9])(-)                      ->  "\1 \2 "   (dash after a digit)
#   then split on whitespace.
# BLEU: max order 4, "exp" smoothing. chrF: character order 6, word order 0, beta 2,
# whitespace removed before extracting character n-grams.
# ---------------------------------------------------------------------------------------------
LITERALS_13A = [("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
RE_13A = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "),
    (r"([^0-9])([\.,])", r"\1 \2 "),
    (r"([\.,])([^0-9])", r" \1 \2"),
    (r"([0-9])(-)", r"\1 \2 "),
]
BLEU_ORDER = 4
CHRF_ORDER = 6
CHRF_BETA = 2

BLEU_FIELDS = ["hyp_len", "ref_len"] + [f"m{n}" for n in range(1, 5)] + [f"t{n}" for n in range(1, 5)]
CHRF_FIELDS = [f"{k}{n}" for n in range(1, 7) for k in ("ch", "cr", "cm")]
STAT_FIELDS = BLEU_FIELDS + CHRF_FIELDS


#: Rows that are worked on at a time, and bytes of their texts but for one row. An n-gram takes about a
#: hundred bytes, and several tasks share a machine.
SLICE_ROWS = 1 << 13
SLICE_BYTES = 1 << 20

#: White space as Python's ``str.split`` has it.
SPACES = np.array([c for c in range(0x3001) if chr(c).isspace()], np.uint32)


def tokenize_13a(lines: pa.Array) -> pa.Array:
    """Lines with one or more spaces around every token."""
    for old, new in LITERALS_13A:
        lines = pc.replace_substring(lines, old, new)
    lines = pc.binary_join_element_wise(" ", lines, " ", "")
    for pattern, new in RE_13A:
        lines = pc.replace_substring_regex(lines, pattern, new)
    return lines


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts in a row, and the text of each."""
    sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    joined = "".join(texts.to_pylist())
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), np.repeat(np.arange(len(texts)), sizes)


def characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the characters but white space, and the text of each."""
    points, text = code_points(texts)
    solid = ~np.isin(points, SPACES)
    return np.unique(points[solid], return_inverse=True)[1], text[solid]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens, and the text of each."""
    # the split looks at the byte behind a text's last space: a line follows the last text, whose byte it is
    lines = pa.concat_arrays([tokenize_13a(texts), pa.array([" "], pa.string())])
    parts = pc.utf8_split_whitespace(lines)[: len(texts)]
    text = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    flat = parts.flatten()
    some = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(some).dictionary_encode().indices.to_numpy(zero_copy_only=False), text[some.to_numpy(zero_copy_only=False)]


def _bits(values: np.ndarray) -> int:
    return int(values.max(initial=0)).bit_length()


def clipped_counts(units: np.ndarray, text: np.ndarray, rows: int, orders: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: n-grams of every row's hypothesis (texts ``0 .. rows - 1``), of its reference (the
    texts after them), and matches."""
    lengths = np.bincount(text, minlength=2 * rows)
    units, row, side = units.astype(np.uint64), (text % rows).astype(np.uint64), (text >= rows).astype(np.uint64)
    one, spare = _bits(units), 63 - max(1, rows - 1).bit_length()
    grams, bits, out = units, one, []
    for n in range(1, orders + 1):
        if n > 1:
            if bits + one > spare:
                grams = np.unique(grams, return_inverse=True)[1].astype(np.uint64)
                bits = _bits(grams)
            grams = grams[:-1] << np.uint64(one) | units[n - 1 :]
            bits += one
        if bits > spare:  # so many different units in one slice
            grams = np.unique(grams, return_inverse=True)[1].astype(np.uint64)
            bits = _bits(grams)
        inside = text[: len(grams)] == text[n - 1 :]
        keys = np.sort((row[: len(grams)] << np.uint64(bits + 1) | grams << np.uint64(1) | side[: len(grams)])[inside])
        totals = np.maximum(lengths - n + 1, 0)
        out.append((totals[:rows], totals[rows:], _matches(keys, bits, rows)))
    return out


def _matches(keys: np.ndarray, bits: int, rows: int) -> np.ndarray:
    if not len(keys):
        return np.zeros(rows, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], (keys[1:] >> np.uint64(1)) != (keys[:-1] >> np.uint64(1)))))
    references = np.add.reduceat((keys & np.uint64(1)).astype(np.int64), starts)
    both = np.minimum(references, np.diff(starts, append=len(keys)) - references)
    return np.bincount((keys[starts] >> np.uint64(bits + 1)).astype(np.int64), both, rows).astype(np.int64)


def row_stats(hyps: pa.Array, refs: pa.Array) -> dict[str, np.ndarray]:
    """``STAT_FIELDS`` of every row; a null text is an empty one."""
    n = len(hyps)
    texts = pa.concat_arrays([pc.fill_null(x.cast(pa.string()), "") for x in (hyps, refs)])
    words, word_text = tokens(texts)
    bleu = clipped_counts(words, word_text, n, BLEU_ORDER)
    out = {"hyp_len": bleu[0][0], "ref_len": bleu[0][1]}
    out |= {f"m{k}": m for k, (_h, _r, m) in enumerate(bleu, 1)} | {f"t{k}": h for k, (h, _r, _m) in enumerate(bleu, 1)}
    for k, (h, r, m) in enumerate(clipped_counts(*characters(texts), n, CHRF_ORDER), 1):
        # hypothesis n-grams of an order only count when the reference has that order
        out |= {f"ch{k}": np.where(r > 0, h, 0), f"cr{k}": r, f"cm{k}": m}
    return out


def slice_bounds(hyps: pa.Array, refs: pa.Array) -> list[int]:
    """First rows of the slices of a batch, and its number of rows."""
    sizes = [pc.fill_null(pc.binary_length(x.cast(pa.string())), 0).to_numpy(zero_copy_only=False) for x in (hyps, refs)]
    upto = np.cumsum(sizes[0].astype(np.int64) + sizes[1])
    full = np.searchsorted(upto, np.arange(SLICE_BYTES, int(upto[-1]) if len(upto) else 0, SLICE_BYTES)) + 1
    return np.unique([0, len(hyps), *full, *range(0, len(hyps), SLICE_ROWS)]).tolist()


def stats_struct(hyps: pa.Array, refs: pa.Array) -> pa.StructArray:
    """``STAT_FIELDS`` of every row of a batch, slice by slice."""
    bounds = slice_bounds(hyps, refs)
    parts = [row_stats(hyps.slice(a, b - a), refs.slice(a, b - a)) for a, b in zip(bounds, bounds[1:], strict=False)]
    columns = [pa.array(np.concatenate([p[f] for p in parts]) if parts else [], pa.int64()) for f in STAT_FIELDS]
    return pa.StructArray.from_arrays(columns, STAT_FIELDS)
