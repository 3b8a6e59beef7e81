"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule is a regular expression over a URL with the literal tokens (runs of
a-z and 0-9, in lower case) that any matching URL must contain as whole tokens.
Every rule is filed under the one of its tokens that is rarest in the URLs at hand
(counted over all of them).  A URL's tokens fetch the rules filed under them,
and only those run their expression; the longest matching rule decides.

Scale: tokens are exploded next to the scan and joined with the rule index,
which is broadcast below a checked size and else shuffled; only narrow URL
columns move.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path
and gets the default verdict; equal rows are judged each for itself; other
columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import small_side, stored


@dataclass(frozen=True)
class Rule:
    name: str | None  #: what is reported as the rule, None for a general pattern
    pattern: str  #: regular expression, searched in ``host + path`` (host ends at the first slash)
    tokens: tuple[str, ...]  #: literals a match contains as whole tokens
    verdict: str
    rank: int  #: the highest rank of the matching rules decides


def address_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for ``host`` and all its subdomains where the URL's path starts with ``path``."""
    # the last run of the path may go on in the URL, so it is no whole token
    inner = re.split(r"[^a-z0-9]+", path.lower())[:-1]
    tokens = [t for t in re.split(r"[^a-z0-9]+", host.lower()) + inner if t]
    return Rule(host + path, rf"^([^/?#]*\.)?{re.escape(host.lower())}{re.escape(path)}", tuple(tokens), verdict,
                1000 + len(host + path))


def general_rule(token: str, before: str, after: str) -> Rule:
    """A blocking pattern: ``token`` between two expressions that match no letter or digit next to it."""
    return Rule(None, f"(?i){before}{re.escape(token)}{after}", (token,), "block", len(token))


#: given rules
ADDRESS_RULES = (
    address_rule("org", "/", "allow"),
    address_rule("example.org", "/es/", "block"),
    address_rule("example.org", "/en/1", "block"),
    address_rule("com", "/fr/", "allow"),
    address_rule("com", "/de/", "block"),
)
#: pages without an article of their own, for URLs that no given rule fits
GENERAL_RULES = tuple(
    [general_rule(t, "/", "(/|$)") for t in ("login", "signin", "signup", "cart", "checkout", "search")]
    + [general_rule(t, r"(^|[./])", r"([./]|$)") for t in ("ads", "adserver", "casino", "porn", "xxx")]
    + [general_rule(t, r"\.", "$") for t in ("zip", "exe", "jpg", "png", "gif", "mp4")])
RULES = ADDRESS_RULES + GENERAL_RULES


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _url_tokens(address: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(address), "[^a-z0-9]+"), lambda t: t != ""))


def rule_index(urls: DataFrame, rules: Sequence[Rule], spark) -> DataFrame:
    """``rules`` as a table, each under the rarest of its tokens; ``urls(tokens)`` gives the counts."""
    listed = spark.createDataFrame(
        [(i, r.name, r.pattern, list(dict.fromkeys(r.tokens)), r.verdict, r.rank) for i, r in enumerate(rules)],
        "rule_no int, name string, pattern string, literals array<string>, rule_verdict string, rank int")
    filed = stored(listed.select("*", F.explode("literals").alias("token")).drop("literals"), "rules")
    wanted = stored(filed.select("token").distinct(), "rule-tokens")
    counts = (urls.select(F.explode("tokens").alias("token")).join(small_side(wanted), "token")
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    known = filed.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = known.groupBy("rule_no").agg(F.min_by("token", F.struct("n", "token")).alias("rarest"))
    return stored(known.join(rarest, "rule_no").filter("token = rarest").drop("rarest", "n"), "rule-index")


def judge_urls(pages: DataFrame, url_col: str = "url", rules: Sequence[Rule] = RULES,
               default: str = "allow") -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule`` and ``verdict`` (columns of those names are replaced)."""
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.withColumns({"__host": host_of(url), "__path": path_of(url)}).drop("host", "path", "rule", "verdict")
    rows = rows.withColumn("__address", F.concat("__host", "__path")).withColumn(
        "__row", F.monotonically_increasing_id())
    rows = stored(rows, "urls")  # fixes the row numbers
    tokens = rows.select("__row", "__address", _url_tokens(F.col("__address")).alias("tokens"))
    index = rule_index(tokens, rules, pages.sparkSession)
    fetched = (tokens.select("__row", "__address", F.explode("tokens").alias("token"))
               .join(small_side(index), "token").filter(F.expr("__address rlike pattern")))
    best = fetched.groupBy(F.col("__row").alias("__at")).agg(
        F.max_by(F.struct("name", "rule_verdict"), F.struct("rank", "rule_no")).alias("__best"))
    return (rows.join(best, F.col("__row") == F.col("__at"), "left")
            .withColumns({"host": F.col("__host"), "path": F.col("__path"), "rule": F.col("__best.name"),
                          "verdict": F.coalesce(F.col("__best.rule_verdict"), F.lit(default))})
            .drop("__host", "__path", "__address", "__row", "__at", "__best"))
