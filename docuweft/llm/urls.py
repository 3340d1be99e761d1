"""Blocking and allowing pages by url: rules are fetched by their rarest literal token, then tried as patterns.

DataFrame functions only.  Rules come in two kinds:

* site rules, ``host/path``: the host and all its subdomains, paths that start
  with the rule's path; of those that fit a url the longest decides;
* pattern rules in the notation of public filter lists: ``||`` a host's start,
  ``^`` a separator or the end, ``*`` anything, ``|`` at an end the url's end.
  They judge urls that no site rule fits; an allowing one wins over a blocking one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, written

BLOCK, ALLOW = "block", "allow"

#: Fixed: site rules of the query's contract.
SITE_RULES = (("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW))
#: Pattern rules for spam, adult and tracking urls.
PATTERN_RULES = (
    ("-pills.", BLOCK), ("||casino.", BLOCK), (".casino.", BLOCK), ("/casino/", BLOCK), ("||xxx.", BLOCK), (".xxx.", BLOCK),
    ("-porn.", BLOCK), ("/porn/", BLOCK), ("||ads.", BLOCK), ("||tracker.", BLOCK), ("/affiliate/*/click", BLOCK),
    ("||docs.", ALLOW),
)


@dataclass(frozen=True)
class UrlRule:
    text: str
    verdict: str
    site: bool

    @property
    def pattern(self) -> str:
        """A regular expression over the url's host and path, for pattern rules over all after ``://``."""
        if self.site:
            return r"(?s)^(?:[^/]*\.)?" + _quoted(self.text)
        body, start, end = self.text, "", ""
        if body.startswith("||"):
            body, start = body[2:], r"^(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, start = body[1:], "^"
        if body.endswith("|"):
            body, end = body[:-1], "$"
        middle = "".join({"*": ".*", "^": r"(?:[^A-Za-z0-9_.%-]|$)"}.get(c) or _quoted(c) for c in body)
        return "(?s)" + start + middle + end

    @property
    def tokens(self) -> list[str]:
        """Literal tokens every fitting url holds whole: letters and digits bounded on both sides within the rule."""
        if self.site:
            text = "." + self.text  # a label begins at a dot or at the host's start
        else:
            text = re.sub(r"^\|\|?", ".", self.text)
            text = re.sub(r"\|$", ".", text)
        return [t.lower() for t in re.findall(r"(?<=[^A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])", text)]


def site_rule(text: str, verdict: str) -> UrlRule:
    """``host/path``; the host is lower-cased, the path begins with its slash."""
    host, _, path = text.partition("/")
    return UrlRule(f"{host.lower()}/{path}", verdict, True)


def pattern_rule(text: str, verdict: str) -> UrlRule:
    return UrlRule(text, verdict, False)


def default_rules() -> list[UrlRule]:
    return [site_rule(*r) for r in SITE_RULES] + [pattern_rule(*r) for r in PATTERN_RULES]


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/_ -])", r"\\\1", text)


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts_of(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and all after the host; empty without ``://``."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.expr("substring(_url, locate('://', _url) + 3)")), F.lit(""))
    host = _ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1)
    return host, F.regexp_extract(tail, r"(?s)^([^?#]*)", 1), tail


def url_tokens(host: Column, tail: Column) -> Column:
    return F.array_distinct(F.split(_ascii_lower(F.concat(host, tail)), "[^a-z0-9]+", -1))


def rule_index(parts: DataFrame, rules: list[UrlRule]) -> DataFrame:
    """(token, rule, pattern, verdict, site, rank): one row per rule under its rarest token.

    How rare a token is, is counted over all urls of ``parts`` (tokens); a rule
    without a token stands under the empty one, which every url asks for.
    """
    spark = parts.sparkSession
    rows = [(n, r.text, r.pattern, r.verdict, r.site, t) for n, r in enumerate(rules) for t in ([*dict.fromkeys(r.tokens)] or [""])]
    known = spark.createDataFrame(rows, "rule_no int, rule string, pattern string, verdict string, site boolean, token string")
    wanted = broadcast_if_small(known.select("token").distinct())
    seen = parts.select(F.explode("tokens").alias("token")).join(wanted, "token").groupBy("token").count()
    counted = known.join(seen, "token", "left").select("*", F.coalesce("count", F.lit(0)).alias("urls"))
    best = counted.groupBy("rule_no").agg(F.min(F.struct("urls", "token", "rule", "pattern", "verdict", "site")).alias("b"))
    return best.select("b.token", "b.rule", "b.pattern", "b.verdict", "b.site")


def judge_urls(pages: DataFrame, rules: list[UrlRule] | None = None) -> DataFrame:
    """Columns of ``pages`` plus host, path, rule (site rule or null), verdict and pattern (the pattern rule that decided, or null).

    Each distinct url is judged once.  Its tokens fetch the rules standing under
    them and only those are tried.  Rules are broadcast after counting; beyond
    the bound they meet the tokens in a shuffle join.  A null url has an empty
    host and path and is allowed, as is a url that nothing fits.  Columns of
    ``pages`` with the names of results give way to them.
    """
    rules = default_rules() if rules is None else rules
    urls = pages.select(F.col("url").alias("_url")).filter("_url is not null").distinct()
    host, path, tail = parts_of(F.col("_url"))
    parts = urls.select("_url", host.alias("host"), path.alias("path"), tail.alias("tail"))
    parts = parts.withColumn("tokens", F.array_union(url_tokens(F.col("host"), F.col("tail")), F.array(F.lit(""))))
    index = broadcast_if_small(rule_index(parts, rules))
    asked = parts.select("_url", "host", "path", "tail", F.explode("tokens").alias("token"))
    subject = F.when(F.col("site"), F.concat("host", "path")).otherwise(F.concat("host", "tail"))
    tried = asked.join(index, "token").filter(F.regexp_like(subject, F.col("pattern")))
    # the longest site rule first, then allowing patterns, then blocking ones
    weight = F.when(F.col("site"), F.length("rule") + 2).otherwise(F.when(F.col("verdict") == ALLOW, 1).otherwise(0))
    found = tried.groupBy("_url").agg(F.max(F.struct(weight.alias("weight"), "rule", "verdict", "site")).alias("_best"))
    taken = {"host", "path", "rule", "verdict", "pattern"}
    own = [c for c in pages.columns if c.lower() not in taken]
    rows = pages.select(*[F.col(f"`{c}`") for c in own], F.col("url").alias("_url"))
    host, path, _ = parts_of(F.col("_url"))
    rows = rows.withColumn("_host", host).withColumn("_path", path)
    # written, so that beyond the bound the join shuffles both sides and can split a hot url; null urls would gather
    found = broadcast_if_small(written(found, "judged-urls"))
    named = rows.filter("_url is not null").join(found, "_url", "left")
    rows = named.unionByName(rows.filter("_url is null").withColumn("_best", F.lit(None).cast(found.schema["_best"].dataType)))
    return rows.select(
        *[F.col(f"`{c}`") for c in own],
        F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.when(F.col("_best.site"), F.col("_best.rule")).alias("rule"),
        F.coalesce("_best.verdict", F.lit(ALLOW)).alias("verdict"),
        F.when(~F.col("_best.site"), F.col("_best.rule")).alias("pattern"),
    )
