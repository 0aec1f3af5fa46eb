"""URL filter with link-graph propagation (built-in functions only).

A rule table judges urls by host suffix and path prefix, the longest rule first. Urls without a rule
get the verdict of their host: personalised PageRank spreads trust from hosts with allowed pages
along the links, and distrust from hosts with blocked pages against the links; a host whose distrust
has too large a share of the two is blocked.

Links are counted per (host, host) before they are shuffled, and the graph is written once under the
shared checkpoint folder; each round joins the scores to it and sums them by host.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalam.llm.tables import stage

#: Letters whose case is folded in hosts: A-Z alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)

DAMPING = 0.85
ROUNDS = 12
MAX_DISTRUST = 0.5


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits; null where none does. The table becomes one
    conditional expression, so it is meant for rule lists of a bounded size."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def judged_urls(pages: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    urls = pages.select(F.col("page_id").alias("page_id"), F.col("url").cast("string").alias("url"))
    parts = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parts.withColumn("m", matched_rule(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("m.rule").alias("rule"), F.col("m.verdict").alias("verdict")
    )


def host_links(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``src, dst, n``: how often pages of a host link to another host, and one link each way between
    a host and the one a label up (``m.a.org`` and ``a.org``) where both have pages.

    Relative links stay on their host and say nothing about others."""
    links = pages.select(host_of(F.col("url").cast("string")).alias("src"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    linked = links.filter("src <> ''").select("src", F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("href"))
    absolute = F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), F.col("href"))).otherwise(F.col("href"))
    written = (
        linked.select("src", host_of(absolute).alias("dst"))
        .filter("dst <> '' AND dst <> src")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = hosts.select("host")
    above = names.select(F.col("host").alias("sub"), F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1).alias("host")).filter("host <> ''")
    family = above.join(names, "host").select(F.col("sub").alias("src"), F.col("host").alias("dst"))
    both = family.unionByName(family.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("n", F.lit(1).cast("long"))
    return written.unionByName(both).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def personalised_rank(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host, score`` after ``rounds`` steps of PageRank that restarts at ``seeds (host, weight)``.

    ``links (src, dst, share)``: a host passes on ``share`` of its score. What a host without links
    holds is not passed on; the scores are compared with each other only."""
    start = seeds.select("host", (F.lit(1 - damping) * F.col("weight")).alias("score"))
    scores = start
    for _ in range(rounds):
        passed = links.join(scores, links.src == scores.host).select(
            F.col("dst").alias("host"), (F.lit(damping) * F.col("share") * F.col("score")).alias("score")
        )
        scores = start.unionByName(passed).groupBy("host").agg(F.sum("score").alias("score"))
    return scores


def host_scores(pages: DataFrame, rules: Sequence[UrlRule] = RULES, rounds: int = ROUNDS) -> DataFrame:
    """``host, trust, distrust`` of every host."""
    counts = judged_urls(pages, rules).filter("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("verdict") == "allow").alias("allowed"),
        F.count_if(F.col("verdict") == "block").alias("blocked"),
    )
    hosts = stage(counts, "hosts")
    links = stage(host_links(pages, hosts), "links")
    trust = _spread(hosts, links, "allowed", "src", "dst", rounds)
    distrust = _spread(hosts, links, "blocked", "dst", "src", rounds)
    return (
        hosts.select("host")
        .join(trust.withColumnRenamed("score", "trust"), "host", "left")
        .join(distrust.withColumnRenamed("score", "distrust"), "host", "left")
        .select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    )


def _spread(hosts: DataFrame, links: DataFrame, seeds: str, source: str, target: str, rounds: int) -> DataFrame:
    total = links.groupBy(F.col(source).alias("src")).agg(F.sum("n").alias("total"))
    shared = links.select(F.col(source).alias("src"), F.col(target).alias("dst"), "n").join(total, "src")
    # a host restarts by the share of its pages that the rules judged so
    weights = hosts.filter(F.col(seeds) > 0).select("host", (F.col(seeds) / F.col("pages")).alias("weight"))
    return personalised_rank(weights, shared.select("src", "dst", (F.col("n") / F.col("total")).alias("share")), rounds=rounds)


def url_filter(
    pages: DataFrame, rules: Sequence[UrlRule] = RULES, max_distrust: float = MAX_DISTRUST, rounds: int = ROUNDS
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    The verdict is the longest rule's. Without a rule it is ``block`` where the host's distrust is
    more than ``max_distrust`` of its trust and distrust together, else ``allow``; a host that neither
    reaches is allowed, and so is an url without a host. Null urls and html count as empty, repeated
    rows are judged alike, an empty table gives an empty result, other columns are ignored."""
    urls = judged_urls(pages, rules)
    scores = stage(host_scores(pages, rules, rounds), "scores")
    bad = scores.filter(F.col("distrust") > F.lit(max_distrust) * (F.col("trust") + F.col("distrust"))).select(
        "host", F.lit(True).alias("distrusted"), "trust", "distrust"
    )
    ruled = urls.filter("rule IS NOT NULL").select("page_id", "host", "path", "rule", "verdict")
    open_ = urls.filter("rule IS NULL").select("page_id", "host", "path", "rule").join(bad.select("host", "distrusted"), "host", "left")
    return ruled.unionByName(
        open_.select("page_id", "host", "path", "rule", F.when(F.col("distrusted"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))
    )
