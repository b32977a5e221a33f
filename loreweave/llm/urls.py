"""URL filters: host and path rules, and patterns indexed by their rarest token.

A pattern rule names the tokens that any URL it matches holds, each as a whole
token or as the whole tokens of which it holds one. The rarest of them, by the
number of URLs, becomes its key: a URL's tokens fetch the rules keyed by them,
and only these run their regular expression. Each different URL
is judged once, and its verdict is joined to all pages with it.

Defined cases: a null or plain text without ``://`` has an empty host and path,
no rule fits and no pattern runs if it is null; equal rows get equal rows; rules
whose key no URL holds never run; no rows give none. Only the id and the URL are
read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loreweave.operators.ranking import keep_first

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains if the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """Blocks URLs that hold ``pattern``; each such URL has all ``tokens``, in lower case.

    A tuple among them names alternatives, of which each such URL has one.
    """

    pattern: str
    tokens: tuple[str | tuple[str, ...], ...]


HOST_RULES = (
    HostRule("allow", "com"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
)
PATTERN_RULES = (
    PatternRule(r"(?i)://[^/?#]*\bcasino-win\b", ("casino", "win")),
    PatternRule(r"(?i)://[^/?#]*\bfree-bets\b", ("free", "bets")),
    PatternRule(r"(?i)://[^/?#]*\badult-[a-z0-9]+\b", ("adult",)),
    PatternRule(r"(?i)://[^/?#]*\bcheap-pills\b", ("cheap", "pills")),
    PatternRule(r"(?i)://[^/?#]*\bspam-farm\b", ("spam", "farm")),
    PatternRule(r"(?i)://[^/?#]*\bads?-track(er|ing)?\b", (("ad", "ads"), ("track", "tracker", "tracking"))),
    PatternRule(r"(?i)://[^/?#]*\blink-farm\b", ("link", "farm")),
    PatternRule(r"(?i)/(wp-login|xmlrpc)\.php\b", ("php",)),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rule(host: Column, path: Column, rules: Sequence[HostRule]) -> Column:
    """The longest rule that fits, as a struct of its name and verdict."""
    chosen = F.lit(None)
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        chosen = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen.cast("struct<rule:string,verdict:string>")


def tokens(url: Column) -> Column:
    return F.array_distinct(F.split(F.translate(url, UPPER, LOWER), "[^a-z0-9]+", -1))


def pattern_hits(urls: DataFrame, rules: Sequence[PatternRule]) -> DataFrame:
    """``url, pattern`` for each different URL and pattern that matches it; ``urls`` has ``url``."""
    spark = urls.sparkSession
    listed = spark.createDataFrame(
        [
            (k, g, r.pattern, t)
            for k, r in enumerate(rules)
            for g, group in enumerate(r.tokens)
            for t in ((group,) if isinstance(group, str) else group)
        ],
        "rule int, place int, pattern string, token string",
    )
    pairs = urls.distinct().select("url", F.explode(tokens(F.col("url"))).alias("token"))
    counts = pairs.join(listed.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    groups = listed.join(counts, "token").groupBy("rule", "place", "pattern")
    groups = groups.agg(F.sum("n").alias("n"), F.sort_array(F.collect_set("token")).alias("tokens"))
    rarest = keep_first(groups, ["rule"], F.col("n"), F.col("tokens"))
    index = rarest.select("rule", "pattern", F.explode("tokens").alias("token"))
    found = pairs.join(index, "token").filter(F.expr("url rlike pattern"))
    return found.select("url", "pattern").distinct()


def judge(
    pages: DataFrame,
    id_col: str,
    url_col: str,
    host_rules: Sequence[HostRule] = HOST_RULES,
    pattern_rules: Sequence[PatternRule] = PATTERN_RULES,
) -> DataFrame:
    """``page_id, url, host, path, rule, verdict, patterns`` of every row.

    A rule whose token is missing from all URLs is not in the index; it would
    match none.
    """
    page = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    hits = pattern_hits(page.select("url").filter(F.col("url").isNotNull()), pattern_rules)
    hits = hits.groupBy("url").agg(F.sort_array(F.collect_set("pattern")).alias("patterns"))
    host, path = host_and_path(F.col("url"))
    page = page.withColumn("host", host).withColumn("path", path)
    page = page.withColumn("fit", host_rule(F.col("host"), F.col("path"), host_rules))
    by_pattern = F.when(F.col("patterns").isNotNull(), "block").otherwise("allow")
    return page.join(hits, "url", "left").select(
        "page_id", "url", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", by_pattern).alias("verdict"),
        F.coalesce("patterns", F.array().cast("array<string>")).alias("patterns"),
    )
