"""URL filters: host and path expressions of each URL, looked up among rules by short hash, confirmed by full digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hexadecimal digits of the SHA-256 digest that the first lookup compares.
SHORT = 8


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, in lower case; empty for null or without ://."""
    found = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(found, F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The rows of pages with the columns host, path, rule and verdict.

    rules has the columns host, path and verdict; a rule fits its host and all subdomains, where the URL's path starts
    with the rule's. The longest rule (host and path together) wins, then the one with the longer host; of two verdicts
    for one rule, block. Without a fitting rule: null and the default. Repeated rows stay; columns of pages named like
    the four new ones are replaced. Rules without host, path or verdict fit nothing. A null or malformed URL has empty
    host and path and gets the default.

    Each distinct (host, path) is expanded once, into those pairs of host suffix and path prefix whose shape (labels,
    path length) some rule has; so the expansion grows with the shapes in use, not with the number of rules.
    """
    rules = rules.where("host != '' AND path IS NOT NULL AND verdict IS NOT NULL").select("host", "path", "verdict")
    told = (
        rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .withColumn("rule", F.concat("host", "path"))
        .withColumn("digest", F.sha2("rule", 256))
        .select(
            F.substring("digest", 1, SHORT).alias("short"), F.col("digest").alias("full"), "rule",
            F.length("host").alias("host_length"), F.col("verdict").alias("told"),
        )
    )  # "block" sorts after "allow"
    # the distinct shapes only: bounded by labels of a host times lengths of a path, whatever the number of rules
    shapes = rules.select(F.size(F.split("host", r"\.")), F.length("path")).distinct().collect()
    shaped = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(m).alias("cut")) for n, m in sorted(shapes)] or [
        F.lit(None).cast("struct<labels:int,cut:int>")
    ])
    pages = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    distinct = pages.select("host", "path").where("host != ''").distinct()
    expanded = (
        distinct.withColumn("shape", F.explode(F.filter(
            shaped, lambda s: (s.labels <= F.size(F.split("host", r"\."))) & (s.cut <= F.length("path"))
        )))
        .withColumn("suffix", F.expr("substring_index(host, '.', -shape.labels)"))
        .withColumn("digest", F.sha2(F.concat("suffix", F.expr("substring(path, 1, shape.cut)")), 256))
        .select("host", "path", F.substring("digest", 1, SHORT).alias("short"), "digest")
    )
    hits = expanded.join(told, "short").where("digest = full").groupBy(
        F.col("host").alias("__host"), F.col("path").alias("__path")
    ).agg(
        F.max(F.struct(F.length("rule"), "host_length", "rule", "told")).alias("best")
    )
    out = pages.join(hits, (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path")), "left")
    return out.withColumns({
        "rule": F.col("best.rule"), "verdict": F.coalesce(F.col("best.told"), F.lit(default)),
    }).drop("best", "__host", "__path")
