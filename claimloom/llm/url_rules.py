"""Operator 9: URL rules by host suffix and path prefix, joined on short hash prefixes.

A URL is expanded into every expression a rule could have: each suffix of its host's
labels with each prefix of its path that is as long as some rule's path.  Expressions
meet rules by the first four bytes of a SHA-256 digest; then the whole digest must agree,
and of the rules that fit the longest decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import columns

PREFIX_HEX = 8
DEFAULT_VERDICT = "allow"

#: The rules of the registered query (host, path, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: empty for NULL and for what has no ``://``."""
    parts = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.regexp_extract(
        url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2
    )
    host, path = (F.coalesce(part, F.lit("")) for part in parts)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, capitals, capitals.lower()), path


def _digest(host: Column, path: Column) -> Column:
    # Neither part of an expression can hold a line feed that matters: a rule's never does.
    return F.sha2(F.concat_ws("\n", host, path), 256)


def _hosts(host: Column) -> Column:
    """The host and each of its suffixes after a dot."""
    labels = F.split(host, r"\.")
    starts = F.sequence(F.lit(1), F.size(labels))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict, a row for each row of ``pages``.

    A rule (host, path, verdict) fits its host and all subdomains if the path starts with
    the rule's.  The longest host and path together wins; between equally long ones the
    longer host, then block.  Rules with a NULL, a line feed, or a host in capitals fit
    nothing.  A NULL URL or one without ``://`` has an empty host and path; without a rule
    that fits, ``rule`` is NULL and the verdict the default.

    Each distinct host and path is expanded once, however many pages have it.  The number
    of expressions is bounded by labels x distinct lengths of the rules' paths, which are
    collected: as many as path lengths, not as rules.  Rules are joined as Spark sees fit;
    hot expressions (one host with a third of the pages) are split by AQE.
    """
    host, path = split_url(pages["url"])
    asked = columns(pages, page_id="page_id", host=host, path=path)
    rules = rules.filter(~F.concat("host", "path").contains("\n") & (F.length("host") > 0))
    sized = rules.select(F.length("path").alias("n")).distinct().collect()
    lengths = F.array(*[F.lit(row.n) for row in sized]).cast("array<int>")

    places = asked.select("host", "path").filter("host != ''").distinct()
    fitting = F.filter(lengths, lambda n: n <= F.length("path"))
    prefixes = F.transform(fitting, lambda n: F.substring("path", F.lit(1), n))
    expressions = places.withColumn("_host", F.explode(_hosts(F.col("host")))).withColumn("_path", F.explode(prefixes))
    expressions = expressions.filter("_host != ''").withColumn("_digest", _digest(F.col("_host"), F.col("_path")))
    expressions = expressions.select("host", "path", F.substring("_digest", 1, PREFIX_HEX).alias("_short"), "_digest")

    known = rules.select(
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("_size"),
        "verdict",
        _digest(F.col("host"), F.col("path")).alias("_whole"),
    ).withColumn("_short", F.substring("_whole", 1, PREFIX_HEX))
    hits = expressions.join(known, "_short").filter(F.col("_digest") == F.col("_whole"))
    rank = F.struct(F.length("rule"), "_size", (F.col("verdict") == "block"))
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), rank).alias("_best"))
    judged = asked.join(best, ["host", "path"], "left")
    verdict = F.coalesce("_best.verdict", F.lit(default))
    return judged.select("page_id", "host", "path", F.col("_best.rule").alias("rule"), verdict.alias("verdict"))
