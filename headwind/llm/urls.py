"""URL filters: host-suffix and path-prefix expressions, joined on short hashes.

A URL is expanded into every host suffix times every path prefix whose length some rule has. An
expression meets the rules on the first 8 hex digits of its SHA-256; the full digest confirms, and
the longest fitting rule wins (then the longer host, then block before allow).

Defined cases: a null url, or one without `://`, has an empty host and path and fits no rule. A url
that no rule fits gets the default verdict. Repeated pages are judged alike, each on its own row.
Without rules every page gets the default. Other columns of the pages pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: fixed value: the rules of the registered query (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def expressions(host: Column, path: Column, lengths: list[int]) -> Column:
    """Array of (host suffix, path prefix) for all suffixes of the host at its dots."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffix = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), ".")
    )
    reach = F.filter(F.array(*map(F.lit, lengths)), lambda k: k <= F.length(path))
    return F.flatten(
        F.transform(
            suffix, lambda h: F.transform(reach, lambda k: F.struct(h.alias("h"), F.substring(path, F.lit(1), k).alias("p")))
        )
    )


def _digest(host: Column | str, path: Column | str) -> Column:
    return F.sha2(F.concat_ws("\n", host, path), 256)


def verdicts(urls: DataFrame, rules: DataFrame, longest_path: int = 2048) -> DataFrame:
    """(url, rule, verdict) of each distinct url that a rule fits.

    The driver sees the distinct lengths of the rules' paths, at most `longest_path` + 1 numbers;
    rules with a longer path are refused.
    """
    known = rules.dropDuplicates(["host", "path", "verdict"]).filter("host is not null and path is not null")
    lengths = sorted(r[0] for r in known.select(F.length("path")).distinct().limit(longest_path + 2).collect())
    if lengths and lengths[-1] > longest_path:
        raise ValueError(f"a rule's path is longer than {longest_path}")
    lookup = known.select(
        F.substring(_digest("host", "path"), 1, 8).alias("short"),
        _digest("host", "path").alias("digest"),
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        F.col("verdict"),
    )
    one = F.col("one")
    found = (
        urls.select("url")
        .filter("url is not null")
        .distinct()
        .withColumn("host", host_of(F.col("url")))
        .filter("host <> ''")
        .select("url", F.explode(expressions(F.col("host"), path_of(F.col("url")), lengths or [0])).alias("one"))
        .select("url", _digest(one["h"], one["p"]).alias("full"))
        .withColumn("short", F.substring("full", 1, 8))
        .join(lookup, "short")
        .filter("full = digest")
    )
    rank = F.struct(
        F.length("rule").alias("length"),
        F.col("host_length"),
        (F.col("verdict") == "block").alias("blocks"),
        F.col("rule"),
        F.col("verdict"),
    )
    best = found.groupBy("url").agg(F.max(rank).alias("best"))
    return best.select("url", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The pages with host, path, rule and verdict; columns of those names are replaced."""
    pages = pages.drop("host", "path", "rule", "verdict")
    return (
        pages.join(verdicts(pages, rules), "url", "left")
        .withColumn("host", host_of(F.col("url")))
        .withColumn("path", path_of(F.col("url")))
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    )


SQL = """
WITH cut AS (
  SELECT page_id, coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '') AS raw,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
parts AS (
  SELECT page_id, path,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM cut),
rules(rh, rp, rv) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
  SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS verdict
  FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (page_id)
"""
