"""DuckDB SQL twins of the registered queries (the correctness oracle).

The SQL is written directly against the driver's pre-registered views (``documents``,
``events``, ...). It re-derives the same fixtures and re-states each operator's semantics in
plain SQL; it shares only the fixed pattern constants with the Spark code.
"""

from __future__ import annotations

from qalam.functions.text import ARABIC_CLASS, DIACRITIC_CLASS, LATIN_CLASS, WS_CLASS
from qalam.sources.fixtures import ARABIC_LETTERS, LATIN_LOWER

# ------------------------------------------------------------------ expression helpers (SQL text)


def fill(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '')"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[{WS_CLASS}]+', ''), '[{WS_CLASS}]+$', '')"


def has_ar(x: str) -> str:
    return f"regexp_matches({x}, '{ARABIC_CLASS}')"


def has_lat(x: str) -> str:
    return f"regexp_matches({x}, '{LATIN_CLASS}')"


def bound(x: str) -> str:
    marker = rf"(?:[{WS_CLASS}\-]|\\n)+"
    return f"regexp_replace(regexp_replace({fill(x)}, '^{marker}', ''), '{marker}$', '')"


def strip_diac(x: str) -> str:
    return f"regexp_replace({x}, '{DIACRITIC_CLASS}', '', 'g')"


def count_diac(x: str) -> str:
    return f"CAST(length({x}) - length({strip_diac(x)}) AS BIGINT)"


def collapse(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[{WS_CLASS}]+', ' ', 'g'), '^ | $', '', 'g')"


def words(x: str) -> str:
    return f"CAST(len(regexp_extract_all({fill(x)}, '[^{WS_CLASS}]+')) AS BIGINT)"


def chars(x: str) -> str:
    return f"CAST(length({fill(x)}) AS BIGINT)"


def swap_mask(en: str = "en", ar: str = "ar") -> str:
    e, a = fill(en), fill(ar)
    return f"({has_ar(e)} AND {has_lat(a)} AND (NOT {has_lat(e)} OR NOT {has_ar(a)}))"


def md5_key(seed: int, col: str = "row_id") -> str:
    return f"md5('{int(seed)}' || '|' || CAST({col} AS VARCHAR))"


# ------------------------------------------------------------------ fixture CTEs

PAIRS_CTE = f"""
l AS (SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS line_no,
             unnest(string_split(text, chr(10))) AS line FROM documents),
kx AS (SELECT doc_id, line_no, line, doc_id*1000 + line_no AS k, (doc_id*7 + line_no) % 5 AS src,
             translate(lower(line), '{LATIN_LOWER}', '{ARABIC_LETTERS}') AS a0
       FROM l WHERE line <> ''),
px AS (SELECT doc_id, line_no, src, k,
             CASE WHEN k % 13 = 0 THEN concat('- ', line) ELSE line END AS e,
             CASE WHEN k % 17 = 0 THEN concat(a0, ' ', chr(92), 'n')
                  WHEN k % 5 = 0 THEN replace(a0, 'ا', concat('ا', 'َ'))
                  ELSE a0 END AS a FROM kx),
pairs AS (SELECT doc_id, line_no, src, k,
             CASE WHEN k % 101 = 0 THEN NULL WHEN k % 97 = 0 THEN a ELSE e END AS en,
             CASE WHEN k % 103 = 0 THEN '  ' WHEN k % 97 = 0 THEN e ELSE a END AS ar FROM px),
raw AS (SELECT k AS row_id, en, ar FROM pairs)"""

CLEANED_CTE = (
    PAIRS_CTE
    + f""",
sw AS (SELECT row_id, en, ar, {swap_mask()} AS m FROM raw),
sx AS (SELECT row_id, CASE WHEN m THEN ar ELSE en END AS en, CASE WHEN m THEN en ELSE ar END AS ar FROM sw),
cl AS (SELECT row_id, {bound('en')} AS en, {collapse(strip_diac(bound('ar')))} AS ar FROM sx),
cleaned AS (SELECT en, ar, min(row_id) AS row_id FROM cl GROUP BY en, ar)"""
)

PREPARED_CTE = (
    CLEANED_CTE
    + f""",
nb AS (SELECT row_id, {strip('en')} AS en, {strip('ar')} AS ar FROM cleaned WHERE en IS NOT NULL AND ar IS NOT NULL),
prepared AS (SELECT row_id, en, ar FROM nb WHERE en <> '' AND ar <> ''),
splitted AS (SELECT row_id, en, ar,
               CASE WHEN substr(md5(en || '|' || ar), 1, 8) < 'e6666666' THEN 'train'
                    WHEN substr(md5(en || '|' || ar), 1, 8) < 'f3333333' THEN 'val'
                    ELSE 'test' END AS split FROM prepared),
bidir AS (SELECT row_id*2 AS row_id, '<2ar> ' || en AS source_text, ar AS target_text,
                 'en_to_ar' AS direction, split FROM splitted
          UNION ALL
          SELECT row_id*2 + 1, '<2en> ' || ar, en, 'ar_to_en', split FROM splitted)"""
)

SOURCES_CTE = (
    PAIRS_CTE
    + """,
srcs AS (SELECT CASE src WHEN 0 THEN 'local_25k' WHEN 1 THEN 'ds2' WHEN 2 THEN 'ds3' WHEN 3 THEN 'ds4' ELSE 'ds5' END AS source,
                src AS source_rank,
                CASE WHEN doc_id % 4 > 0 THEN 'train' ELSE 'test' END AS split_name,
                CASE WHEN doc_id % 4 > 0 THEN 0 ELSE 1 END AS split_rank,
                k AS row_id, en, ar FROM pairs)"""
)


def with_(cte: str, body: str) -> str:
    return f"WITH {cte}\n{body}"


# ------------------------------------------------------------------ corpus-build oracles


def _side_stats(fn, with_max: bool) -> str:
    rows = [("mean", "avg({s})")] + [(f"p{int(p*100)}", f"quantile_cont({{s}}, {p})") for p in (0.5, 0.9, 0.95, 0.99)]
    if with_max:
        rows.append(("max", "CAST(max({s}) AS DOUBLE)"))
    parts = []
    for name, agg in rows:
        e = agg.format(s="en")
        a = agg.format(s="ar")
        parts.append(
            f"SELECT '{name}' AS metric, CAST(round_even(CAST({e} AS DOUBLE), 2) AS DOUBLE) AS en, "
            f"CAST(round_even(CAST({a} AS DOUBLE), 2) AS DOUBLE) AS ar FROM w"
        )
    return with_(CLEANED_CTE + f",\nw AS (SELECT {fn('en')} AS en, {fn('ar')} AS ar FROM cleaned)", "\nUNION ALL\n".join(parts))


def _funnel_cte() -> str:
    return (
        PAIRS_CTE
        + f""",
d1 AS (SELECT DISTINCT en, ar FROM raw),
d1m AS (SELECT en, ar, {swap_mask()} AS m FROM d1),
d2 AS (SELECT DISTINCT CASE WHEN m THEN ar ELSE en END AS en, CASE WHEN m THEN en ELSE ar END AS ar FROM d1m),
b AS (SELECT {fill('en')} AS e0, {fill('ar')} AS a0, {bound('en')} AS eb, {bound('ar')} AS ab FROM d2),
d3 AS (SELECT DISTINCT eb AS en, {collapse(strip_diac('ab'))} AS ar FROM b),
fun AS (SELECT
   (SELECT count(*) FROM raw) AS merged,
   (SELECT count(*) FROM d1) AS after_dedup,
   (SELECT count(*) FILTER (WHERE m) FROM d1m) AS swapped,
   (SELECT count(*) FROM d2) AS after_swap,
   (SELECT count(*) FILTER (WHERE e0 <> eb) FROM b) AS dash_newline_en,
   (SELECT count(*) FILTER (WHERE a0 <> ab) FROM b) AS dash_newline_ar,
   (SELECT CAST(coalesce(sum({count_diac('ab')}), 0) AS BIGINT) FROM b) AS diacritic_chars,
   (SELECT count(*) FILTER (WHERE {count_diac('ab')} > 0) FROM b) AS diacritic_rows,
   (SELECT count(*) FROM d3) AS final)"""
    )


def _metric_rows(cte: str, src: str, items: list[tuple[str, str]], zero_ratio: bool) -> str:
    parts = []
    for name, cond in items:
        cnt = f"count(*) FILTER (WHERE {cond})"
        ratio = f"CASE WHEN count(*) > 0 THEN {cnt} / count(*) ELSE {'0.0' if zero_ratio else 'NULL'} END"
        parts.append(f"SELECT '{name}' AS metric, CAST({cnt} AS BIGINT) AS count, CAST({ratio} AS DOUBLE) AS ratio FROM {src}")
    return with_(cte, "\nUNION ALL\n".join(parts))


def _anomaly_sql(select: str) -> str:
    body = _metric_rows(
        CLEANED_CTE,
        "cleaned",
        [("en_contains_arabic", has_ar(fill("en"))), ("ar_contains_latin", has_lat(fill("ar")))],
        zero_ratio=False,
    )
    return body if select == "*" else f"SELECT {select} FROM ({body}) t"


def _pct_text(x: str) -> str:
    d = f"CAST(CAST(round_even({x} * 100, 4) AS DECIMAL(38,4)) AS VARCHAR)"
    return f"regexp_replace(regexp_replace({d}, '0+$', ''), '\\.$', '.0') || '%'"


def _split_rows(src: str) -> str:
    return f"""(SELECT s.split, CAST(count(b.split) AS BIGINT) AS rows
   FROM (VALUES ('train'), ('val'), ('test')) s(split) LEFT JOIN {src} b ON b.split = s.split GROUP BY s.split)"""


def _detect(x: str) -> str:
    t = strip(fill(x))
    return f"CASE WHEN {t} = '' THEN '' WHEN {has_ar(t)} THEN 'ar_to_en' ELSE 'en_to_ar' END"


_SRC_COLS = "CASE source WHEN 'local_25k' THEN 'English,Arabic' WHEN 'ds2' THEN 'caption,caption_multi' WHEN 'ds3' THEN 'en,ar' WHEN 'ds4' THEN 'sentence,translation' ELSE 'english,arabic' END"


def corpus_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["standardize_pairs"] = with_(SOURCES_CTE, "SELECT source, split_name, row_id, en, ar FROM srcs")
    q["union_sources"] = with_(SOURCES_CTE, "SELECT source, split_name, row_id, en, ar FROM srcs")
    q["rows_by_source"] = with_(SOURCES_CTE, "SELECT source, CAST(count(*) AS BIGINT) AS rows FROM srcs GROUP BY ROLLUP (source)")
    q["read_splits"] = with_(
        SOURCES_CTE, "SELECT source, split_name, row_id, en AS first, ar AS second FROM srcs WHERE source_rank IN (1, 2, 3)"
    )
    q["cap_rows"] = with_(
        SOURCES_CTE, "SELECT source, split_name, row_id, en, ar FROM srcs QUALIFY row_number() OVER (PARTITION BY source ORDER BY split_rank, row_id) <= 1000"
    )
    q["source_schema_report"] = with_(
        SOURCES_CTE,
        f"SELECT source, split_name, CAST(count(*) AS BIGINT) AS rows, {_SRC_COLS} AS columns FROM srcs GROUP BY source, split_name",
    )
    q["fill_text"] = with_(PAIRS_CTE, f"SELECT row_id, {fill('en')} AS en, {fill('ar')} AS ar FROM raw")
    q["script_flags"] = with_(
        PAIRS_CTE,
        f"SELECT row_id, {has_ar(fill('en'))} AS en_has_arabic, {has_lat(fill('en'))} AS en_has_latin, "
        f"{has_ar(fill('ar'))} AS ar_has_arabic, {has_lat(fill('ar'))} AS ar_has_latin FROM raw",
    )
    q["swap_mask"] = with_(PAIRS_CTE, f"SELECT row_id, {swap_mask()} AS swap FROM raw")
    q["swap_fix"] = with_(
        PAIRS_CTE,
        f"SELECT row_id, CASE WHEN {swap_mask()} THEN ar ELSE en END AS en, CASE WHEN {swap_mask()} THEN en ELSE ar END AS ar FROM raw",
    )
    q["swap_preview"] = with_(PAIRS_CTE, f"SELECT row_id, en, ar FROM raw WHERE {swap_mask()} ORDER BY row_id LIMIT 10")
    q["clean_boundaries"] = with_(PAIRS_CTE, f"SELECT row_id, {bound('en')} AS en, {bound('ar')} AS ar FROM raw")
    q["clean_boundaries_stats"] = with_(
        PAIRS_CTE,
        f"SELECT count(*) FILTER (WHERE {fill('en')} <> {bound('en')}) AS en_changed, "
        f"count(*) FILTER (WHERE {fill('ar')} <> {bound('ar')}) AS ar_changed FROM raw",
    )
    q["strip_diacritics"] = with_(PAIRS_CTE, f"SELECT row_id, {strip_diac(fill('ar'))} AS ar FROM raw")
    q["diacritic_stats"] = with_(
        PAIRS_CTE,
        f"SELECT CAST(coalesce(sum({count_diac(fill('ar'))}), 0) AS BIGINT) AS diacritic_chars, "
        f"count(*) FILTER (WHERE {count_diac(fill('ar'))} > 0) AS diacritic_rows FROM raw",
    )
    q["collapse_whitespace"] = with_(PAIRS_CTE, f"SELECT row_id, {collapse(fill('ar'))} AS ar FROM raw")
    q["dedup_pairs"] = with_(PAIRS_CTE, "SELECT min(row_id) AS row_id, en, ar FROM raw GROUP BY en, ar")
    q["cleaned_corpus"] = with_(CLEANED_CTE, "SELECT row_id, en, ar FROM cleaned")
    q["cleaning_funnel"] = with_(
        _funnel_cte(),
        "SELECT merged, after_dedup, swapped, after_dedup - after_swap AS removed_after_swap, dash_newline_en, "
        "dash_newline_ar, diacritic_chars, diacritic_rows, after_swap - final AS removed_after_diacritics, final FROM fun",
    )
    q["eda_summary"] = with_(
        _funnel_cte(),
        "SELECT final AS rows, ['en', 'ar'] AS columns, CAST(128 AS BIGINT) AS max_seq_len_reference, merged - after_dedup AS duplicate_pairs_before_dedup, "
        "CASE WHEN merged > 0 THEN (merged - after_dedup) / merged ELSE 0.0 END AS duplicate_ratio_before_dedup, "
        "swapped AS swap_count, after_dedup - after_swap AS rededup_removed_after_swap, "
        "diacritic_chars AS diacritics_removed_chars FROM fun",
    )
    q["drop_blank_pairs"] = with_(PREPARED_CTE, "SELECT row_id, en, ar FROM prepared")
    q["pair_duplicate_stats"] = with_(
        PAIRS_CTE + ",\nt AS (SELECT count(*) AS total, (SELECT count(*) FROM (SELECT DISTINCT en, ar FROM raw)) AS unique_pairs FROM raw)",
        "SELECT total, unique_pairs, total - unique_pairs AS duplicate_pairs, "
        "CASE WHEN total > 0 THEN (total - unique_pairs) / total ELSE 0.0 END AS duplicate_ratio FROM t",
    )
    q["null_empty_profile"] = with_(
        PAIRS_CTE,
        "\nUNION ALL\n".join(
            f"SELECT '{s}' AS \"column\", count(*) FILTER (WHERE {s} IS NULL) AS null_count, "
            f"count(*) FILTER (WHERE {strip(fill(s))} = '') AS empty_or_whitespace_count FROM raw"
            for s in ("en", "ar")
        ),
    )
    q["unique_sentence_counts"] = with_(
        CLEANED_CTE,
        "\nUNION ALL\n".join(
            f"SELECT '{s}' AS \"column\", CAST(count(DISTINCT {s}) AS BIGINT) AS unique_count, "
            f"count(DISTINCT {s}) / count(*) AS unique_ratio FROM cleaned"
            for s in ("en", "ar")
        ),
    )
    q["word_length_stats"] = _side_stats(words, with_max=False)
    q["char_length_stats"] = _side_stats(chars, with_max=True)
    q["length_outliers"] = with_(
        CLEANED_CTE,
        "\nUNION ALL\n".join(
            f"(SELECT '{s}' AS side, row_id, {chars(s)} AS char_len, substr({fill(s)}, 1, 200) AS text "
            f"FROM cleaned ORDER BY char_len DESC, row_id LIMIT 1)"
            for s in ("en", "ar")
        ),
    )
    q["script_anomalies"] = _anomaly_sql("*")
    q["truncation_estimate"] = _metric_rows(
        CLEANED_CTE,
        "cleaned",
        [
            ("en_gt_max_len", f"{words('en')} > 128"),
            ("ar_gt_max_len", f"{words('ar')} > 128"),
            ("either_side_gt_max_len", f"{words('en')} > 128 OR {words('ar')} > 128"),
        ],
        zero_ratio=True,
    )
    q["frame_shape"] = with_(
        CLEANED_CTE,
        "SELECT count(*) AS rows, CAST(2 AS BIGINT) AS columns, "
        "CAST(coalesce(sum(strlen(en) + strlen(ar)), 0) AS BIGINT) AS text_bytes FROM cleaned",
    )
    q["top_sentences"] = with_(
        CLEANED_CTE,
        "\nUNION ALL\n".join(
            f"(SELECT '{s}' AS side, {fill(s)} AS text, count(*) AS count FROM cleaned GROUP BY 2 ORDER BY count DESC, text LIMIT 10)"
            for s in ("en", "ar")
        ),
    )
    q["format_ratio"] = f"SELECT metric, count, {_pct_text('ratio')} AS ratio_text FROM ({_anomaly_sql('*')}) t"
    q["hash_split"] = with_(PREPARED_CTE, "SELECT row_id, en, ar, split FROM splitted")
    q["split_counts"] = with_(
        PREPARED_CTE, "SELECT split, count(*) AS rows, round_even(count(*) / sum(count(*)) OVER (), 4) AS ratio FROM splitted GROUP BY split"
    )
    q["direction_split_counts"] = with_(PREPARED_CTE, "SELECT split, direction, count(*) AS rows FROM bidir GROUP BY split, direction")
    q["leakage_check"] = with_(
        PREPARED_CTE,
        "SELECT count(*) FILTER (WHERE n > 1) AS leak_count FROM (SELECT en, ar, count(DISTINCT split) AS n FROM splitted GROUP BY en, ar) t",
    )
    q["bidirectional_expand"] = with_(PREPARED_CTE, "SELECT row_id, source_text, target_text, direction, split FROM bidir")
    q["split_views"] = with_(PREPARED_CTE, "SELECT * FROM " + _split_rows("bidir") + " t")
    q["tag_direction"] = with_(
        PREPARED_CTE, "SELECT row_id, '<2ar> ' || en AS src_en_to_ar, '<2en> ' || ar AS src_ar_to_en FROM splitted"
    )
    q["detect_direction"] = with_(PAIRS_CTE, f"SELECT row_id, {_detect('en')} AS dir_en, {_detect('ar')} AS dir_ar FROM raw")
    q["head_rows"] = with_(CLEANED_CTE, "SELECT row_id, en, ar FROM cleaned ORDER BY row_id LIMIT 10")
    q["sample_exact"] = with_(CLEANED_CTE, f"SELECT row_id, en, ar FROM cleaned ORDER BY {md5_key(42)}, row_id LIMIT 10")
    q["shuffle_take"] = with_(
        PREPARED_CTE,
        f"SELECT row_id, source_text, target_text, direction, split FROM bidir WHERE split = 'train' ORDER BY {md5_key(42)}, row_id LIMIT 24",
    )
    picked = f"pk AS (SELECT row_id, en, ar FROM splitted WHERE split = 'test' ORDER BY {md5_key(42)}, row_id LIMIT 10)"
    q["preview_pairs"] = with_(
        PREPARED_CTE + ",\n" + picked,
        "SELECT row_id*2 AS row_id, 'en_to_ar' AS direction, '<2ar> ' || en AS source_text, ar AS reference_text FROM pk "
        "UNION ALL SELECT row_id*2 + 1, 'ar_to_en', '<2en> ' || ar, en FROM pk",
    )
    fwd = "substr(md5('42|dir|' || CAST(row_id AS VARCHAR)), 32, 1) IN ('0','2','4','6','8','a','c','e')"
    q["preview_pairs_single"] = with_(
        PREPARED_CTE + ",\n" + picked,
        f"SELECT CASE WHEN {fwd} THEN row_id*2 ELSE row_id*2 + 1 END AS row_id, "
        f"CASE WHEN {fwd} THEN 'en_to_ar' ELSE 'ar_to_en' END AS direction, "
        f"CASE WHEN {fwd} THEN '<2ar> ' || en ELSE '<2en> ' || ar END AS source_text, "
        f"CASE WHEN {fwd} THEN ar ELSE en END AS reference_text FROM pk",
    )
    return q


# ------------------------------------------------------------------ run-log oracles

METRIC_LOG_CTE = """
mlog AS (SELECT user_id % 5 AS run_id, event_id // 10 * 40 AS step, event_id AS ingest_seq,
                value / 50 AS val_loss, fmod(value, 11) AS val_ppl, fmod(value, 30) AS bleu, fmod(value, 7) * 10 AS chrf,
                CASE WHEN event_id % 3 > 0 THEN fmod(value, 1) END AS comet, fmod(value, 13) AS bleu_en_to_ar,
                fmod(value, 17) AS bleu_ar_to_en, fmod(value, 19) AS chrf_en_to_ar, fmod(value, 23) AS chrf_ar_to_en FROM events),
ulog AS (SELECT * FROM mlog QUALIFY row_number() OVER (PARTITION BY run_id, step ORDER BY ingest_seq DESC) = 1)"""


def _ppl(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) THEN 'NaN'::DOUBLE ELSE exp(least({x}, 20)) END"


def _finite(x: str) -> str:
    return f"({x} IS NOT NULL AND NOT isnan({x}) AND NOT isinf({x}))"


def _batched(split: str | None, size: int = 24) -> str:
    """Consecutive batches within each split (``split=None``: every split)."""
    where = f" WHERE split = '{split}'" if split else ""
    return (
        f"bt AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY split ORDER BY {md5_key(42)}, row_id) - 1) / {size}) AS BIGINT) AS batch_id "
        f"FROM bidir{where})"
    )


def _words_sql(x: str) -> str:
    return words(x)


def run_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["coerce_numeric"] = (
        "SELECT user_id % 5 AS run_id, CAST((event_id % 200) * 40 AS BIGINT) AS step, event_id AS ingest_seq, "
        "TRY_CAST(CAST(value / 50 AS VARCHAR) AS DOUBLE) AS val_loss, TRY_CAST(CAST(fmod(value, 30) AS VARCHAR) AS DOUBLE) AS bleu, "
        "TRY_CAST(props AS DOUBLE) AS props FROM events"
    )
    q["loss_to_ppl"] = with_(METRIC_LOG_CTE, f"SELECT run_id, step, val_loss, round({_ppl('val_loss')}, 6) AS val_ppl FROM ulog")
    q["upsert_metric_log"] = with_(METRIC_LOG_CTE, "SELECT * FROM ulog")
    q["sort_by_step"] = with_(METRIC_LOG_CTE, "SELECT run_id, step, val_loss FROM ulog ORDER BY run_id, step")
    parts = []
    maxima = ("bleu", "chrf", "comet", "bleu_en_to_ar", "bleu_ar_to_en", "chrf_en_to_ar", "chrf_ar_to_en")
    for m, mode in (("val_loss", "min"), ("val_ppl", "min"), *((m, "max") for m in maxima)):
        order = f"{m} ASC" if mode == "min" else f"{m} DESC"
        parts.append(
            f"SELECT run_id, '{m}' AS metric, step, {m} AS value FROM ulog WHERE {_finite(m)} "
            f"QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY {order}, step) = 1"
        )
    q["best_points"] = with_(METRIC_LOG_CTE, "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts))
    q["rolling_mean"] = with_(
        METRIC_LOG_CTE,
        f"SELECT run_id, step, val_loss AS value, avg(CASE WHEN {_finite('val_loss')} THEN val_loss END) "
        "OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS smooth FROM ulog",
    )
    q["running_best"] = with_(
        METRIC_LOG_CTE
        + f""",
rb AS (SELECT run_id, step, val_loss, CASE WHEN {_finite('val_loss')} THEN val_loss END AS v,
          min(CASE WHEN {_finite('val_loss')} THEN val_loss END) OVER (PARTITION BY run_id ORDER BY step
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ulog)""",
        "SELECT run_id, step, val_loss AS value, coalesce(v IS NOT NULL AND (before IS NULL OR v < before), false) AS is_best, "
        "CASE WHEN before IS NULL THEN v WHEN v IS NULL THEN before ELSE least(before, v) END AS best_so_far FROM rb",
    )
    q["retain_last_n"] = with_(
        METRIC_LOG_CTE,
        "SELECT run_id, step, row_number() OVER (PARTITION BY run_id ORDER BY step DESC) <= 10 AS keep FROM ulog "
        "WHERE step % 500 = 0 OR step = 32000",
    )
    q["cadence_flags"] = with_(
        METRIC_LOG_CTE,
        "SELECT run_id, step, (step % 40 = 0 OR step = 1) AS should_log, (step % 400 = 0 OR step = 32000) AS should_eval, "
        "(step % 500 = 0 OR step = 32000) AS should_save FROM ulog",
    )
    q["interval_metrics"] = """WITH
m AS (SELECT 0 AS run_id, event_id AS micro, ts, value / 50 AS loss, CAST(floor(event_id / 32) AS BIGINT) + 1 AS s FROM events),
t AS (SELECT *, CASE WHEN s = 1 THEN 1 ELSE CAST(ceil(s / 40) * 40 AS BIGINT) END AS interval_end FROM m),
g AS (SELECT run_id, interval_end, avg(loss) AS avg_loss, min(ts) AS first_ts, max(ts) AS last_ts FROM t GROUP BY run_id, interval_end),
a AS (SELECT run_id, interval_end, avg_loss,
             (epoch_us(last_ts) - epoch_us(coalesce(lag(last_ts) OVER (PARTITION BY run_id ORDER BY interval_end), first_ts))) / 1e6 AS seconds FROM g),
lm AS (SELECT max(micro) AS last_micro FROM m),
c AS (SELECT a.*, interval_end - CASE WHEN interval_end = 1 THEN 0 WHEN interval_end = 40 THEN 1 ELSE interval_end - 40 END AS steps
      FROM a, lm WHERE interval_end * 32 - 1 <= last_micro),
r AS (SELECT *, CASE WHEN seconds > 0 THEN steps / seconds ELSE 0.0 END AS sps FROM c)
SELECT CAST(run_id AS BIGINT) AS run_id, CAST(interval_end AS BIGINT) AS interval_end, round(avg_loss, 6) AS avg_loss,
       round(""" + _ppl("avg_loss") + """, 6) AS ppl, CAST(steps AS BIGINT) AS steps, round(seconds, 6) AS seconds,
       round(sps, 6) AS steps_per_sec, round(CASE WHEN sps > 0 THEN 1.0 / sps ELSE 'inf'::DOUBLE END, 6) AS sec_per_step,
       CAST(interval_end * 768 AS BIGINT) AS examples_seen, round(interval_end * 768 / 1489852, 6) AS approx_epochs FROM r"""
    q["validation_loss"] = (
        "WITH v AS (SELECT coalesce(avg(value / 50), 'NaN'::DOUBLE) AS val_loss FROM events WHERE event_id < 300) "
        f"SELECT round(val_loss, 6) AS val_loss, round({_ppl('val_loss')}, 6) AS val_ppl FROM v"
    )
    q["training_volume"] = with_(
        PREPARED_CTE + ",\nn AS (SELECT count(*) AS n FROM bidir WHERE split = 'train')",
        """SELECT metric, value FROM (
  SELECT 'examples_per_micro_batch' AS metric, 24.0::DOUBLE AS value UNION ALL
  SELECT 'gradient_accumulation_steps', 32.0 UNION ALL
  SELECT 'examples_per_optimizer_step', 768.0 UNION ALL
  SELECT 'max_steps', 32000.0 UNION ALL
  SELECT 'examples_seen_total', 24576000.0 UNION ALL
  SELECT 'train_examples', (SELECT CAST(n AS DOUBLE) FROM n) UNION ALL
  SELECT 'approx_epochs_over_train_split', (SELECT round_even(CAST(24576000.0 / n AS DOUBLE), 4) FROM n) UNION ALL
  SELECT 'coverage_percent_of_train_split %', (SELECT round_even(CAST(24576000.0 / n * 100 AS DOUBLE), 2) FROM n)) t""",
    )
    q["assign_batches"] = with_(PREPARED_CTE + ",\n" + _batched(None), "SELECT row_id, split, batch_id FROM bt")
    tps_cte = (
        PREPARED_CTE
        + ",\n"
        + _batched("train")
        + f""",
tk AS (SELECT CAST(floor(batch_id / 32) AS BIGINT) + 1 AS optimizer_step, batch_id,
              {words('source_text')} AS src, {words('target_text')} AS tgt FROM bt),
st AS (SELECT optimizer_step, CAST(sum(src) AS BIGINT) AS src_tokens, CAST(sum(tgt) AS BIGINT) AS tgt_tokens
       FROM tk GROUP BY optimizer_step HAVING count(DISTINCT batch_id) = 32 AND optimizer_step <= 200)"""
    )
    q["tokens_per_step"] = with_(tps_cte, "SELECT optimizer_step, src_tokens, tgt_tokens, src_tokens + tgt_tokens AS total_tokens FROM st")
    q["tokens_per_step_summary"] = with_(
        tps_cte,
        "SELECT count(*) AS steps, round(avg(src_tokens + tgt_tokens), 6) AS mean, "
        "round(quantile_cont(src_tokens + tgt_tokens, 0.5), 6) AS p50, round(quantile_cont(src_tokens + tgt_tokens, 0.9), 6) AS p90, "
        "min(src_tokens + tgt_tokens) AS min, max(src_tokens + tgt_tokens) AS max FROM st",
    )
    return q


# ------------------------------------------------------------------ evaluation oracles

_SYM = r"([\{-\~\[-\` -\&\(-\+\:-\@\/])"


def tok13a(x: str) -> str:
    pre = f"replace(replace(replace({x}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    pre = f"replace(replace(replace(replace({pre}, '&quot;', '\"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>')"
    s = f"(' ' || {pre} || ' ')"
    s = f"regexp_replace({s}, '{_SYM}', ' \\1 ', 'g')"
    s = f"regexp_replace({s}, '([^0-9])([\\.,])', '\\1 \\2 ', 'g')"
    s = f"regexp_replace({s}, '([\\.,])([^0-9])', ' \\1 \\2', 'g')"
    s = f"regexp_replace({s}, '([0-9])(-)', '\\1 \\2 ', 'g')"
    return f"regexp_extract_all({s}, '[^{WS_CLASS}]+')"


PRED_CTE = (
    PREPARED_CTE
    + f""",
preds AS (SELECT row_id, direction, source_text, target_text,
            CASE (row_id // 2) % 4 WHEN 0 THEN target_text
                 WHEN 1 THEN substr(target_text, 1, CAST(floor(length(target_text) * 0.8) AS BIGINT))
                 WHEN 2 THEN replace(target_text, ' the ', ' ')
                 ELSE substr(source_text, 7) END AS prediction
          FROM bidir WHERE split = 'test'),
tp AS (SELECT row_id, direction, {strip(fill('prediction'))} AS hyp, {strip(fill('target_text'))} AS ref FROM preds),
tk AS (SELECT row_id, direction, {tok13a('hyp')} AS ht, {tok13a('ref')} AS rt,
              regexp_replace(hyp, '[{WS_CLASS}]+', '', 'g') AS hc, regexp_replace(ref, '[{WS_CLASS}]+', '', 'g') AS rc FROM tp),
hg AS (SELECT t.row_id, o.n, array_to_string(list_slice(t.ht, i.i + 1, i.i + o.n), chr(1)) AS g, count(*) AS c
       FROM tk t, range(1, 5) o(n), range(0, greatest(len(t.ht) - o.n + 1, 0)) i(i) GROUP BY 1, 2, 3),
rg AS (SELECT t.row_id, o.n, array_to_string(list_slice(t.rt, i.i + 1, i.i + o.n), chr(1)) AS g, count(*) AS c
       FROM tk t, range(1, 5) o(n), range(0, greatest(len(t.rt) - o.n + 1, 0)) i(i) GROUP BY 1, 2, 3),
bm AS (SELECT h.row_id, h.n, sum(least(h.c, r.c)) AS m FROM hg h JOIN rg r ON h.row_id = r.row_id AND h.n = r.n AND h.g = r.g GROUP BY 1, 2),
hcg AS (SELECT t.row_id, o.n, substr(t.hc, i.i, o.n) AS g, count(*) AS c
        FROM tk t, range(1, 7) o(n), range(1, greatest(length(t.hc) - o.n + 2, 1)) i(i) GROUP BY 1, 2, 3),
rcg AS (SELECT t.row_id, o.n, substr(t.rc, i.i, o.n) AS g, count(*) AS c
        FROM tk t, range(1, 7) o(n), range(1, greatest(length(t.rc) - o.n + 2, 1)) i(i) GROUP BY 1, 2, 3),
cm AS (SELECT h.row_id, h.n, sum(least(h.c, r.c)) AS m FROM hcg h JOIN rcg r ON h.row_id = r.row_id AND h.n = r.n AND h.g = r.g GROUP BY 1, 2),
bmw AS (SELECT row_id, """
    + ", ".join(f"sum(m) FILTER (WHERE n = {n}) AS m{n}" for n in range(1, 5))
    + """ FROM bm GROUP BY row_id),
cmw AS (SELECT row_id, """
    + ", ".join(f"sum(m) FILTER (WHERE n = {n}) AS cm{n}" for n in range(1, 7))
    + """ FROM cm GROUP BY row_id),
st AS (SELECT t.row_id, t.direction, len(t.ht) AS hyp_len, len(t.rt) AS ref_len, """
    + ", ".join(f"coalesce(b.m{n}, 0) AS m{n}, greatest(len(t.ht) - {n - 1}, 0) AS t{n}" for n in range(1, 5))
    + ", "
    + ", ".join(
        f"CASE WHEN greatest(length(t.rc) - {n - 1}, 0) > 0 THEN greatest(length(t.hc) - {n - 1}, 0) ELSE 0 END AS ch{n}, "
        f"greatest(length(t.rc) - {n - 1}, 0) AS cr{n}, coalesce(c.cm{n}, 0) AS cm{n}"
        for n in range(1, 7)
    )
    + """
       FROM tk t LEFT JOIN bmw b ON b.row_id = t.row_id LEFT JOIN cmw c ON c.row_id = t.row_id)"""
)

_STAT_COLS = ["hyp_len", "ref_len"] + [f"m{n}" for n in range(1, 5)] + [f"t{n}" for n in range(1, 5)] + [
    f"{k}{n}" for n in range(1, 7) for k in ("ch", "cr", "cm")
]


def _bleu_sql() -> str:
    bp = "CASE WHEN hyp_len < ref_len THEN CASE WHEN hyp_len > 0 THEN exp(1 - ref_len / hyp_len) ELSE 0.0 END ELSE 1.0 END"
    logs = []
    z = "0"
    for n in range(1, 5):
        z = f"{z} + CASE WHEN m{n} = 0 THEN 1 ELSE 0 END"
        logs.append(f"ln(CASE WHEN m{n} > 0 THEN 100.0 * m{n} / t{n} ELSE 100.0 / (pow(2.0, {z}) * t{n}) END)")
    guard = " OR ".join(f"t{n} = 0" for n in range(1, 5)) + " OR (m1 = 0 AND m2 = 0 AND m3 = 0 AND m4 = 0)"
    return f"CASE WHEN {guard} THEN 0.0 ELSE ({bp}) * exp(({' + '.join(logs)}) / 4) END"


def _chrf_sql() -> str:
    ok = [f"(ch{n} > 0 AND cr{n} > 0)" for n in range(1, 7)]
    eff = " + ".join(f"CASE WHEN {o} THEN 1 ELSE 0 END" for o in ok)
    prec = "0.0 + " + " + ".join(f"CASE WHEN {ok[n - 1]} THEN cm{n} / ch{n} ELSE 0.0 END" for n in range(1, 7))
    rec = "0.0 + " + " + ".join(f"CASE WHEN {ok[n - 1]} THEN cm{n} / cr{n} ELSE 0.0 END" for n in range(1, 7))
    p = f"(CASE WHEN ({eff}) > 0 THEN ({prec}) / ({eff}) ELSE 0.0 END)"
    r = f"(CASE WHEN ({eff}) > 0 THEN ({rec}) / ({eff}) ELSE 0.0 END)"
    return f"CASE WHEN {p} + {r} > 0 THEN 100.0 * 5.0 * {p} * {r} / (4.0 * {p} + {r}) ELSE 0.0 END"


def _sums_sql() -> str:
    return ", ".join(f"sum({c}) AS {c}" for c in _STAT_COLS)


def eval_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["trim_predictions"] = with_(PRED_CTE, "SELECT row_id, hyp AS prediction, ref AS target_text FROM tp")
    q["align_predictions"] = with_(PRED_CTE, "SELECT row_id, direction, source_text, target_text, prediction FROM preds")
    q["corpus_bleu"] = with_(PRED_CTE + f",\nsm AS (SELECT {_sums_sql()} FROM st)", f"SELECT round({_bleu_sql()}, 6) AS bleu FROM sm")
    q["corpus_chrf"] = with_(PRED_CTE + f",\nsm AS (SELECT {_sums_sql()} FROM st)", f"SELECT round({_chrf_sql()}, 6) AS chrf FROM sm")
    by_dir = (
        PRED_CTE
        + f",\nsm AS (SELECT direction, count(*) AS num_samples, {_sums_sql()} FROM st GROUP BY GROUPING SETS ((), (direction))),"
        + f"\nsc AS (SELECT direction, num_samples, CAST(ceil(num_samples / 24) AS BIGINT) AS num_batches, "
        + f"round({_bleu_sql()}, 6) AS bleu, round({_chrf_sql()}, 6) AS chrf FROM sm)"
    )
    q["scores_by_direction"] = with_(by_dir, "SELECT direction, num_samples, num_batches, bleu, chrf FROM sc")
    q["eval_text_metrics"] = with_(
        by_dir,
        """SELECT max(num_samples) FILTER (WHERE direction IS NULL) AS num_samples,
       max(num_batches) FILTER (WHERE direction IS NULL) AS num_batches,
       max(bleu) FILTER (WHERE direction IS NULL) AS bleu, max(chrf) FILTER (WHERE direction IS NULL) AS chrf,
       'NaN'::DOUBLE AS comet,
       max(bleu) FILTER (WHERE direction = 'en_to_ar') AS bleu_en_to_ar, max(bleu) FILTER (WHERE direction = 'ar_to_en') AS bleu_ar_to_en,
       max(chrf) FILTER (WHERE direction = 'en_to_ar') AS chrf_en_to_ar, max(chrf) FILTER (WHERE direction = 'ar_to_en') AS chrf_ar_to_en
FROM sc""",
    )
    q["batch_predict"] = with_(
        PREPARED_CTE,
        "SELECT row_id, direction, source_text, target_text, "
        f"{strip('CASE WHEN starts_with(source_text, ' + chr(39) + '<2ar> ' + chr(39) + ') OR starts_with(source_text, ' + chr(39) + '<2en> ' + chr(39) + ') THEN substr(source_text, 7) ELSE source_text END')} AS prediction "
        "FROM bidir WHERE split = 'test'",
    )
    q["map_batches"] = with_(CLEANED_CTE, "SELECT row_id, CAST(length(en) AS BIGINT) AS en_chars, CAST(length(ar) AS BIGINT) AS ar_chars FROM cleaned")
    return q


# ------------------------------------------------------------------ tokens


def token_oracles() -> dict[str, str]:
    from qalam.functions.bytelevel import SPECIAL_TOKENS, TAG_AR_ID, TAG_EN_ID

    tokens = ", ".join(f"('{t}', {i})" for i, t in enumerate(SPECIAL_TOKENS))
    q: dict[str, str] = {}
    q["decode_roundtrip"] = with_(
        PREPARED_CTE, "SELECT row_id, direction, split, source_text AS decoded_input_ids, target_text AS decoded_labels FROM bidir"
    )
    q["special_token_audit"] = with_(
        PREPARED_CTE + f",\nn AS (SELECT CASE direction WHEN 'en_to_ar' THEN {TAG_AR_ID} ELSE {TAG_EN_ID} END AS id, count(*) AS rows "
        f"FROM bidir GROUP BY 1),\nspecial AS (SELECT * FROM (VALUES {tokens}) v(token, id))",
        "SELECT token, CAST(special.id AS INTEGER) AS id, true AS probe_2ar_first, true AS probe_2en_first, "
        "coalesce(rows, 0) AS tagged_rows, coalesce(rows, 0) AS tag_first_rows FROM special LEFT JOIN n ON n.id = special.id",
    )
    return q


# ------------------------------------------------------------------ source/sink round trips


def io_oracles() -> dict[str, str]:
    from qalam.sources.readers import PANDAS_NA_VALUES

    na = ", ".join("'" + v.replace("'", "''") + "'" for v in PANDAS_NA_VALUES)
    q: dict[str, str] = {}
    q["write_pairs"] = with_(CLEANED_CTE, "SELECT row_id, en, ar FROM cleaned")
    q["read_pairs_parquet"] = q["write_pairs"]
    q["read_pairs_csv"] = with_(
        CLEANED_CTE,
        f"SELECT row_id, CASE WHEN en IN ({na}) THEN NULL ELSE en END AS en, CASE WHEN ar IN ({na}) THEN NULL ELSE ar END AS ar FROM cleaned",
    )
    q["write_metric_log"] = with_(METRIC_LOG_CTE, "SELECT run_id, step, ingest_seq, val_loss, bleu, chrf, comet FROM ulog")
    q["read_metric_log"] = with_(METRIC_LOG_CTE, "SELECT run_id, step, ingest_seq, val_loss, bleu, chrf, comet FROM mlog")
    return q
