"""DuckDB SQL for the registered queries that SQL can express.

The others have a fitted model, a tokenizer, sampled signatures or hundreds of regexes whose overlaps
suppress each other; their tests compare them with brute force or with the libraries.
"""

from __future__ import annotations

from qalam.llm import line_dedup, quality_rules, url_trust

SPACE = r"[\x20\x09-\x0D]"
NO_SPACE = r"[^\x20\x09-\x0D]"

EXACT_DEDUP = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM d WINDOW w AS (PARTITION BY text)
"""


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _share(n: str, of: str) -> str:
    return f"CASE WHEN {of} > 0 THEN {n} / {of} ELSE 0.0 END"


def quality() -> str:
    """Windows by the words themselves, rules from the threshold table."""
    tests = []
    for rule in quality_rules.RULES:
        unless = f" OR NOT {rule.only}" if rule.only else ""
        tests += [f"({rule.measure} >= {rule.low}{unless})"] if rule.low is not None else []
        tests += [f"({rule.measure} <= {rule.high}{unless})"] if rule.high is not None else []
    langs = ", ".join(_quoted(x) for x in quality_rules.STOP_LANGS)
    stop = ", ".join(_quoted(w) for w in quality_rules.STOP_WORDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
p AS (SELECT r, doc_id, lang, text, [x FOR x IN regexp_split_to_array(text, '{SPACE}+') IF x <> ''] AS words,
             [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '{NO_SPACE}')] AS lines FROM d),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM p),
t AS (SELECT r, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS three FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS times FROM t WHERE three IS NOT NULL),
n AS (SELECT r, least(3, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 3)) AS covers FROM g WHERE times > 1),
c AS (SELECT r, CAST(sum(covers) AS BIGINT) AS n_repeat_words FROM n GROUP BY r),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(regexp_extract_all(text, '!!')) AS n_shouts,
             len([x FOR x IN words IF lower(x) IN ({stop})]) AS n_stop_words,
             coalesce(lower(regexp_extract(lang, '^\\s*([A-Za-z]+)', 1)) IN ({langs})
                      AND 2 * len(regexp_extract_all(text, '\\p{{Latin}}')) >= len(regexp_extract_all(text, '\\p{{L}}')), false) AS in_stop_lang
      FROM p LEFT JOIN c ON c.r = p.r),
s AS (SELECT *, {_share("word_chars", "n_words")} AS mean_word_length, {_share("n_symbols", "n_words")} AS symbol_ratio,
             {_share("n_stop_words", "n_words")} AS stop_word_ratio, {_share("n_dup_lines", "n_lines")} AS dup_line_ratio,
             {_share("n_shouts", "n_words")} AS shout_ratio, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(tests)} AS kept,
       mean_word_length, symbol_ratio, stop_word_ratio, dup_line_ratio, shout_ratio FROM s
"""


def line_spread() -> str:
    """Distinct sites of every line, counted exactly."""
    words = f"^(?:{SPACE}*{NO_SPACE}+{SPACE}+){{{line_dedup.MIN_WORDS - 1}}}{SPACE}*{NO_SPACE}"
    spaces = " || ".join(f"chr({ord(c)})" for c in line_dedup.SPACE_CHARS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS site, coalesce(text, '') AS text FROM documents),
s AS (SELECT r, doc_id, site, text, string_split(text, chr(10)) AS lines FROM d),
l AS (SELECT r, site, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM s),
k AS (SELECT *, CASE WHEN regexp_matches(line, '{words}') THEN trim(line, {spaces}) END AS key FROM l),
common AS (SELECT key FROM k WHERE key IS NOT NULL GROUP BY key HAVING count(DISTINCT site) >= {line_dedup.MIN_SITES}),
f AS (SELECT k.*, common.key IS NOT NULL AS lost FROM k LEFT JOIN common ON common.key = k.key),
a AS (SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_boilerplate, sum(length(line)) AS total,
             coalesce(sum(length(line)) FILTER (WHERE lost), 0) AS gone,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '') AS clean FROM f GROUP BY r),
b AS (SELECT a.*, gone <= {line_dedup.MAX_SHARE} * total AS page FROM a)
SELECT doc_id, n_lines, n_boilerplate, CASE WHEN page THEN n_boilerplate ELSE 0 END AS n_removed,
       sha256(CASE WHEN page AND n_boilerplate > 0 THEN clean ELSE text END) AS text_sha256
FROM s JOIN b ON b.r = s.r
"""


def _host(url: str) -> str:
    """SQL of a url's host; empty without ``://``."""
    after = f"substr({url}, strpos({url}, '://') + 3)"
    host = f"regexp_extract({after}, '^[^/?#]*')"
    return f"CASE WHEN strpos({url}, '://') > 0 THEN translate({host}, '{url_trust.UPPER}', '{url_trust.LOWER}') ELSE '' END"


def _path(url: str) -> str:
    after = f"substr({url}, strpos({url}, '://') + 3)"
    return f"CASE WHEN strpos({url}, '://') > 0 THEN regexp_extract({after}, '^[^/?#]*([^?#]*)', 1) ELSE '' END"


def url_verdicts() -> str:
    """The rounds of both ranks, one after the other."""
    fits = sorted(url_trust.RULES, key=lambda r: (-len(r.text), r.text))
    test = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    rule = "CASE " + " ".join(f"WHEN {test(r)} THEN '{r.text}'" for r in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {test(r)} THEN '{r.verdict}'" for r in fits) + " END"
    href = url_trust.HREF.replace("'", "''")
    ranks = []
    for name, seeds, source, target in (("trust", "allowed", "src", "dst"), ("distrust", "blocked", "dst", "src")):
        ranks.append(f"{name}_start AS (SELECT host, (1 - {url_trust.DAMPING}) * ({seeds} / pages) AS score FROM hosts WHERE {seeds} > 0)")
        ranks.append(f"{name}_links AS (SELECT {source} AS a, {target} AS b, n / sum(n) OVER (PARTITION BY {source}) AS share FROM links)")
        last = f"{name}_start"
        for i in range(url_trust.ROUNDS):
            ranks.append(
                f"{name}_{i} AS (SELECT host, sum(score) AS score FROM (SELECT * FROM {name}_start UNION ALL "
                f"SELECT b AS host, {url_trust.DAMPING} * share * score AS score FROM {name}_links JOIN {last} ON {last}.host = a) GROUP BY host)"
            )
            last = f"{name}_{i}"
    last = url_trust.ROUNDS - 1
    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, html, {_host("url")} AS host, {_path("url")} AS path FROM u),
j AS (SELECT page_id, html, host, path, {rule} AS rule, {verdict} AS verdict FROM h),
hosts AS (SELECT host, count(*) AS pages, count(*) FILTER (WHERE verdict = 'allow') AS allowed,
                 count(*) FILTER (WHERE verdict = 'block') AS blocked FROM j WHERE host <> '' GROUP BY host),
refs AS (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1)) AS href FROM j WHERE host <> ''),
absolute AS (SELECT src, CASE WHEN starts_with(href, '//') THEN 'http:' || href ELSE href END AS href FROM refs),
written AS (SELECT src, {_host("href")} AS dst FROM absolute),
above AS (SELECT host AS sub, regexp_extract(host, '^[^.]+\\.(.+\\..+)$', 1) AS host FROM hosts),
family AS (SELECT sub, above.host FROM above JOIN hosts ON hosts.host = above.host),
links AS (SELECT src, dst, count(*) AS n FROM (SELECT src, dst FROM written WHERE dst <> '' AND dst <> src UNION ALL
          SELECT sub, host FROM family UNION ALL SELECT host, sub FROM family) GROUP BY src, dst),
{", ".join(ranks)},
bad AS (SELECT d.host FROM distrust_{last} d LEFT JOIN trust_{last} t ON t.host = d.host
        WHERE d.score > {url_trust.MAX_DISTRUST} * (coalesce(t.score, 0) + d.score))
SELECT page_id, j.host, path, rule, coalesce(verdict, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN bad ON bad.host = j.host
"""


ORACLES: dict[str, str] = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op5_quality_rules": quality(),
    "op8_url_trust": url_verdicts(),
    "op10_line_dedup": line_spread(),
}
