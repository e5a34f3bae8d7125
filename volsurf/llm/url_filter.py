"""URL filtering by pattern rules indexed under their rarest literal token.

A rule is a regular expression over ``host + path`` with the literal tokens
that any match must contain.  It is indexed under the one of them that occurs in
fewest rules; ties go to the longer token.  A URL is cut into tokens at everything but letters and
digits; its distinct tokens fetch candidate rules with one equi-join, and only
candidates run their regular expression.

All of it is DataFrame functions.  URLs are judged once per distinct URL, so
copies of one URL cost one evaluation.  The index is broadcast when it has at
most BROADCAST_RULES rows, and joined by token beyond; the rarest token keeps
popular tokens (``com``, ``www``) out of it as far as rules allow.

Edge cases: a null URL and one without ``://`` have empty host and path and
match no rule.  Rules without any literal token are indexed under the empty
token, which every URL carries.  Several matches: the longest rule text wins,
then the alphabetically first.  Repeated rows stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_RULES = 100_000


class Rule(NamedTuple):
    """``tokens`` must occur in whatever ``pattern`` matches; ``rank`` 1 overrides rank 0."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int = 0


def prefix_rule(host: str, path: str, verdict: str) -> Rule:
    """A host with all its subdomains, and paths that start with ``path``."""
    found = tuple(re.findall("[a-z0-9]+", host))
    # the last token of the path may go on in the URL, so it is no whole token there
    inner = tuple(re.findall("[A-Za-z0-9]+(?=[^A-Za-z0-9])", path))
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{'' if path else '(?=/|$)'}{re.escape(path)}", found + inner, 1)


def pattern_rule(name: str, verdict: str, pattern: str, tokens: Sequence[str]) -> Rule:
    return Rule(name, verdict, pattern, tuple(tokens), 0)


def index(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """(token, rule, verdict, pattern, rank): each rule once, under its rarest token."""
    often = Counter(t for r in rules for t in set(r.tokens))
    rows = [(min(set(r.tokens), key=lambda t: (often[t], -len(t), t), default=""), r.name, r.verdict, r.pattern, str(r.rank)) for r in rules]
    fields = ("token", "rule", "rule_verdict", "pattern", "rank")
    made = [F.struct(*(F.lit(v).alias(k) for k, v in zip(fields, row, strict=True))) for row in rows]
    if not made:
        return spark.range(0).select(*(F.lit(None).cast("string").alias(f) for f in fields))
    return spark.range(1).select(F.inline(F.array(*made)))


def host_of(url):
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url):
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(df: DataFrame, rules: Sequence[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule (null if none matched) and verdict; columns of these names are replaced."""
    base = df.drop(*({"host", "path", "rule", "verdict"} - {url_col}))
    urls = base.select(F.col(url_col).alias("_url")).filter(F.col("_url").isNotNull()).distinct()
    parts = urls.select("_url", F.concat(host_of(F.col("_url")), path_of(F.col("_url"))).alias("_at"))
    tokens = F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.col("_at"), "[^A-Za-z0-9]+")))
    asked = parts.select("_url", "_at", F.explode(tokens).alias("token"))
    entries = index(df.sparkSession, rules)
    hits = asked.join(F.broadcast(entries) if len(rules) <= BROADCAST_RULES else entries, "token")
    hits = hits.filter(F.expr("_at rlike pattern"))
    best = hits.groupBy("_url").agg(F.min(F.struct(-F.col("rank").cast("int"), -F.length("rule"), "rule", "rule_verdict")).alias("_best"))
    rows = base.join(best, F.col(url_col) == F.col("_url"), "left")
    kept = [F.col(f"`{c}`") for c in base.columns]
    url = F.col(url_col)
    return rows.select(*kept, host_of(url).alias("host"), path_of(url).alias("path"), F.col("_best.rule").alias("rule"), F.coalesce("_best.rule_verdict", F.lit(default)).alias("verdict"))
