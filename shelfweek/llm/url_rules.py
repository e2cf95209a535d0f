"""URL filters: host suffixes and path prefixes of every URL, looked up by short hash prefixes.

A URL is expanded into one expression for each suffix of its host (at label borders) and each prefix of its path whose
length some rule has. Expressions meet rules on the first characters of their digests, as a compact rule list would be
shared, and the whole digest confirms them. The longest rule wins; of equally long rules the one with the longer host,
then the blocking one.

Defined cases: a null URL, or one without ``://``, has an empty host and path, and no rule fits it; a URL that no rule
fits gets the default verdict; repeated URLs get equal verdicts; empty tables of pages or rules are fine; columns that
are not named are neither read nor changed.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules as (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
DEFAULT = "allow"
PREFIX = 8  # hexadecimal characters of a digest that are compared first


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """A short list of rules as a table (host, path, verdict); long lists are given as tables."""
    if not rules:
        return spark.range(0).select(*[F.lit("").alias(c) for c in ("host", "path", "verdict")])
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def expressions(host: Column, path: Column, lengths: list[int]) -> Column:
    """Host suffixes times the path prefixes of the given lengths."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the distinct URLs that a rule fits; ``urls`` has url, host and path."""
    # Path lengths of rules: at most as many as the longest path has characters.
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect() if r[0] is not None)
    if not lengths:
        return urls.select("url", F.lit("").alias("rule"), F.lit("").alias("verdict")).limit(0)
    listed = rules.select("host", "verdict", F.concat("host", "path").alias("rule"))
    listed = listed.select("*", F.sha2("rule", 256).alias("digest"))
    listed = listed.select("*", F.substring("digest", 1, PREFIX).alias("short"))
    each = urls.where("host <> ''").distinct().select("url", F.explode(expressions(F.col("host"), F.col("path"), lengths)).alias("expression"))
    each = each.select("url", F.sha2("expression", 256).alias("found")).select("*", F.substring("found", 1, PREFIX).alias("short"))
    hits = each.join(listed, "short").where("found = digest")
    rank = F.struct(F.length("rule").alias("n"), F.length("host").alias("h"), (F.col("verdict") == "block").alias("b"), "rule", "verdict")
    return hits.groupBy("url").agg(F.max(rank).alias("best")).select("url", "best.rule", "best.verdict")


def judged(pages: DataFrame, rules: DataFrame | None = None, id_column: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    rules = rule_table(pages.sparkSession) if rules is None else rules
    rows = pages.select(F.col(id_column).alias("id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    best = matched(rows.select("url", "host", "path"), rules)
    out = rows.join(best, "url", "left")
    return out.select(F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
