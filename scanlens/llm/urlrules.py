"""URL rules by expression lookup.

A URL is expanded into host-suffix and path-prefix expressions.  Expressions meet the
rules in an equi-join on a four-byte hash prefix; the full digest then confirms the
match and rule precedence picks one.  Built from column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlens.llm.common import BROADCAST_BYTES, SALTS, table_bytes
from scanlens.session import written

#: Verdict of a URL that no rule fits.
DEFAULT = "allow"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def _suffixes(host: Column, labels: list[int]) -> Column:
    """The last labels of the host, as many as rule hosts have; a host of any length has no more suffixes than those."""
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    asked = F.filter(F.array(*(F.lit(n) for n in labels)).cast("array<int>"), lambda n: n <= dots + 1)
    return F.transform(asked, lambda n: F.call_function("substring_index", host, F.lit("."), -n))


def _expression(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: key, host, path, rule, verdict.

    ``rules(host, path, verdict)``: a rule fits its host and all subdomains if the
    path of the URL starts with the rule's.  The longest rule text wins, then the
    longer host; of equal rules ``block`` wins.  Without a fitting rule the verdict is
    ``allow`` and ``rule`` null.  A null URL or one without ``://`` has an empty host
    and path; rules with null parts are ignored.  Repeated rows are judged one by one.

    Hosts are cut at the numbers of labels that rule hosts have, paths at the lengths that
    rule paths have, so expressions per URL are bounded by the rules, however long it is.
    Columns other than the two named are not read.  Rules are broadcast if their measured size
    allows, else both sides are dealt out by hash prefix and salt.
    """
    host, path = split_url(F.col(url))
    rows = written(pages.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), host.alias("host"), path.alias("path")), "urls")
    mine = rules.where("host is not null and path is not null and verdict is not null").select(F.lower("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    mine = mine.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))  # "block" is after "allow"
    digest = F.sha2(_expression(F.col("rule_host"), F.col("rule_path")), 256)
    mine = written(mine.withColumn("rule_digest", digest).withColumn("prefix", F.substring(digest, 1, 8)), "rules")
    cuts = F.filter(F.array(*(F.lit(n) for n in _lengths(mine))).cast("array<int>"), lambda n: n <= F.length("path"))
    wide = rows.select("row", F.explode(_suffixes(F.col("host"), _labels(mine))).alias("h"), "path", cuts.alias("cuts"))
    wide = wide.select("row", "h", F.explode(F.transform("cuts", lambda n: F.substring(F.col("path"), F.lit(1), n))).alias("p"))
    digest = F.sha2(_expression(F.col("h"), F.col("p")), 256)
    wide = wide.select("row", digest.alias("digest")).withColumn("prefix", F.substring("digest", 1, 8))
    if table_bytes(mine) <= BROADCAST_BYTES:
        met = wide.join(F.broadcast(mine), "prefix")
    else:
        salted = mine.withColumn("salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
        met = wide.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["prefix", "salt"])
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("m"), rule.alias("rule"), F.col("verdict").alias("verdict"))
    best = met.where("digest = rule_digest").groupBy("row").agg(F.max(rank).alias("best"))
    return rows.join(best, "row", "left").select(
        F.col("key").alias(key), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict")
    )


def _labels(mine: DataFrame) -> list[int]:
    """Numbers of labels that rule hosts have."""
    dots = F.length("rule_host") - F.length(F.replace(F.col("rule_host"), F.lit("."), F.lit("")))
    return sorted(r.n for r in mine.select((dots + 1).alias("n")).distinct().collect())


def _lengths(mine: DataFrame) -> list[int]:
    """Lengths rule paths have; at most as many as the longest path has characters."""
    return sorted(r.n for r in mine.select(F.length("rule_path").alias("n")).distinct().collect())


#: The five rules of the registered query, in SQL.
JUDGE_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
hp AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
judged AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM hp)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM judged
"""
