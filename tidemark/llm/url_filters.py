"""URL filters by hashed host-suffix and path-prefix expressions.

A rule is a host and a path; it fits that host and its subdomains where the URL's path starts with
the rule's. Each URL is expanded into (host suffix, path up to a slash) expressions, each rule into
the one expression that every URL it fits must have. Expressions meet in an equi-join on a short
prefix of their SHA-256; then full digests and the rest of the rule's path are compared, and the
longest rule wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, stored, take

PREFIX_HEX = 8
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# The rules of the query, as (action, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def _folder(path: Column) -> Column:
    """The path up to and with its last slash; empty without one."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit(" "), folder), 256)


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", columns: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Per page: page_id, host, path, rule and verdict.

    A NULL URL or one without ``://`` has an empty host and path. Longest means most code points of
    host and path together; then the longer host, then block. URLs without a rule get ``otherwise``.
    Rules with a NULL part are ignored, repeated ones count once. Repeated pages each get their row;
    an empty table gives none. Further columns are ignored.
    """
    key, url = columns
    parts = take(pages, key, url).select(
        F.col(key).alias("page_id"),
        ascii_lower(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit(""))).alias("host"),
        F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit("")).alias("path"),
    )
    known = stored(
        take(rules, "action", "host", "path").dropna().distinct().select(
            "action",
            F.col("host").alias("rule_host"),
            F.col("path").alias("rule_path"),
            _digest(F.col("host"), _folder(F.col("path"))).alias("rule_digest"),
            F.size(F.split("host", r"\.")).alias("_labels"),
            F.size(F.split(_folder(F.col("path")), "/")).alias("_folders"),
        ),
        "url-rules",
    )
    # Longer suffixes and deeper folders than any rule has can fit no rule.
    deepest = known.agg(F.max("_labels"), F.max("_folders")).first()
    labels, folders = deepest[0] or 0, deepest[1] or 0

    # The verdict depends on host and path alone: each distinct pair is expanded once.
    sites = parts.select("host", "path").distinct()
    label, step = F.split("host", r"\."), F.split("path", "/")
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(label) - (labels - 1)), F.size(label)),
        lambda i: F.array_join(F.slice(label, i, F.size(label)), "."),
    )
    stems = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(max(1, folders)), F.size(step))),
        lambda i: F.when(i == 1, F.lit("")).otherwise(F.concat(F.array_join(F.slice(step, 1, i - 1), "/"), F.lit("/"))),
    )
    found = (
        sites.withColumn("suffix", F.explode(suffixes))
        .withColumn("stem", F.explode(stems))
        .withColumn("digest", _digest(F.col("suffix"), F.col("stem")))
        .withColumn("_short", F.substring("digest", 1, PREFIX_HEX))
        .join(known.withColumn("_short", F.substring("rule_digest", 1, PREFIX_HEX)), "_short")
        .filter((F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path")))
    )
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(rule), F.length("rule_host"), F.col("action") == "block", rule.alias("rule"), "action")
    best = found.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return parts.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(otherwise)).alias("verdict"),
    )


ORACLE_SQL = """
WITH rules(action, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
parts AS (
  SELECT row_number() OVER () AS i, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
best AS (
  SELECT i, arg_max(struct_pack(rule := h || p, action := action), length(h || p)) AS b
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY i)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.action, 'allow') AS verdict FROM parts LEFT JOIN best USING (i)"""
