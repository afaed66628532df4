"""URL filter rules found through their rarest literal token, in SQL functions only.

A rule is a regular expression over ``host + path`` with the whole tokens
(runs of a-z and 0-9) that every match holds.  Token frequencies are counted
over all URLs; each rule is filed under its rarest token.  The tokens of a
URL fetch the rules filed under them, and only those run their expression.
Rules without a sure token are tested on every URL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is searched in host + path; ``tokens`` are whole tokens of every match; larger ``rank`` wins."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def path_rule(verdict: str, rule: str) -> UrlRule:
    """A rule like ``example.net/en/``: the host with all subdomains, and paths that start so.  Longer rules win."""
    host, slash, path = rule.partition("/")
    whole = host.lower() + slash + path.lower()
    tokens = re.findall(r"[a-z0-9]+", whole if whole[-1:] == "/" else whole[:len(whole.rstrip("abcdefghijklmnopqrstuvwxyz0123456789"))])
    return UrlRule(rule, verdict, "^(?:[^/]*\\.)?" + re.escape(host + slash + path), tuple(dict.fromkeys(tokens)), len(rule))


def word_rule(verdict: str, *tokens: str) -> UrlRule:
    """A rule for hosts that hold these tokens in a row, joined by ``-`` (rank below every path rule)."""
    pattern = "^(?:[^/]*[^/a-z0-9])?" + "-".join(map(re.escape, tokens)) + "(?:[^/a-z0-9]|/|$)"
    return UrlRule("host:" + "-".join(tokens), verdict, pattern, tokens, 0)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host up to ``/ ? #``, A-Z lower-cased; the path up to ``? #``; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path


def url_tokens(whole: Column) -> Column:
    """The distinct tokens of host + path."""
    return F.array_distinct(F.array_remove(F.split(F.translate(whole, UPPER, LOWER), "[^a-z0-9]+"), ""))


def rarest_tokens(urls: DataFrame, rules: Sequence[UrlRule]) -> dict[str, str]:
    """Rule name -> its rarest token over all of ``urls`` (column ``whole``); ties by the alphabet.

    Only tokens of rules are counted, so the counts that reach the driver are
    bounded by the rules.
    """
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    rows = (urls.select(F.explode(F.array_intersect(url_tokens(F.col("whole")), F.array(*map(F.lit, wanted)))).alias("token"))
            .groupBy("token").count().collect())
    counts = {r["token"]: r["count"] for r in rows}
    return {r.name: min(r.tokens, key=lambda t: (counts.get(t, 0), t)) for r in rules if r.tokens}


def match_rules(df: DataFrame, rules: Sequence[UrlRule], url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule (the winning rule's name or null) and verdict to every row.

    Candidate rules are found and tested once per distinct host + path, and the
    winners joined back.  A null URL, or one without ``://``, has an empty host
    and path and gets ``default`` unless a rule without tokens matches the empty
    string.  Repeated rows are kept.  Ties of rank go to the smaller name.
    """
    spark = df.sparkSession
    host, path = split_url(F.col(url))
    others = [c for c in df.columns if c not in ("host", "path", "rule", "verdict", "__whole")]
    parts = df.select(*others, host.alias("host"), path.alias("path")).withColumn("__whole", F.concat("host", "path"))
    whole = parts.select(F.col("__whole").alias("whole")).distinct()
    rarest = rarest_tokens(whole, rules)
    # One row per rule: the size of the list that the caller gives.
    filed = spark.createDataFrame([(rarest.get(r.name, ""), r.name, r.verdict, r.pattern, r.rank) for r in rules],
                                  "token string, name string, verdict string, pattern string, rank int")
    fetched = (whole.select("whole", F.explode(F.array_append(url_tokens(F.col("whole")), F.lit(""))).alias("token"))
               .join(filed, "token").filter(F.expr("whole rlike pattern")))
    won = fetched.groupBy("whole").agg(F.min(F.struct((-F.col("rank")).alias("r"), "name", "verdict")).alias("w"))
    return (parts.join(won, F.col("__whole") == F.col("whole"), "left")
            .select(*others, "host", "path", F.col("w.name").alias("rule"),
                    F.coalesce("w.verdict", F.lit(default)).alias("verdict")))
