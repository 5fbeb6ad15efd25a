"""URL filters: rules found by joining host-suffix and path-prefix expressions on short hash prefixes.

A URL's expressions are its host and parent domains, each with every beginning of its path
that is as long as some rule's path. Expressions and rules meet on the first four bytes of
their SHA-256; what meets is confirmed by the whole digest, and of a URL's rules the longest
decides. Equal (host, path) pairs are judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.common import free_name, table

#: (verdict, host, path) of the production list.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: Verdict for a URL that no rule fits.
DEFAULT = "allow"
PREFIX_BYTES = 4


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if null or without ``://``."""
    found = F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty if null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    # No host of a URL holds a slash, so the first one tells where the path begins.
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256))


def expressions(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path`` and the digest ``full`` of each expression that could be a rule's.

    The lengths of the rules' paths and their numbers of labels are collected: no more
    values than the longest rule has characters.
    """
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    labels = sorted(r[0] for r in rules.select(F.size(F.split("rule_host", r"\."))).distinct().collect())
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(F.array(*map(F.lit, labels)).cast("array<int>"), lambda k: k <= F.size(parts)),
        lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda k: k <= F.length("path")),
        lambda k: F.substring(F.col("path"), F.lit(1), k),
    )
    each = places.select("host", "path", F.explode(suffixes).alias("h"), prefixes.alias("p"))
    return each.select("host", "path", "h", F.explode("p").alias("p")).select("host", "path", digest(F.col("h"), F.col("p")).alias("full"))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "rule_verdict string, rule_host string, rule_path string")


def filtered(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``rules`` has ``rule_verdict``, ``rule_host``, ``rule_path``; rows with a null are left
    out. A rule fits its host and all subdomains if the URL's path starts with the rule's.
    The longest rule wins, of equally long ones that with the longer host; where a rule
    is listed with both verdicts, block wins. Null URLs and URLs without ``://`` have an
    empty host and path, so only a rule without them could fit. Every row is kept,
    repeated ones too; columns named like results are replaced.
    """
    pages = pages.drop(*[c for c in ("host", "path", "rule", "verdict") if c != url])
    h, p = free_name("host_of", pages.columns), free_name("path_of", pages.columns)
    # One regular expression run per row: the columns below are read from here, not computed anew.
    placed = pages.withColumn(h, host_of(F.col(url))).withColumn(p, path_of(F.col(url)))
    rules = rules.where("rule_verdict is not null and rule_host is not null and rule_path is not null")
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    places = placed.select(F.col(h).alias("host"), F.col(p).alias("path")).distinct()
    short = lambda x: F.substring(x, 1, PREFIX_BYTES)
    asked = expressions(places, rules).withColumn("short", short("full"))
    listed = rules.withColumn("rule_full", digest(F.col("rule_host"), F.col("rule_path"))).withColumn("short", short("rule_full"))
    met = asked.join(listed, "short").where("full = rule_full")
    best = met.groupBy("host", "path").agg(
        F.max(F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("host_size"),
            F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict"),
        )).alias("b")
    )
    best = best.select(F.col("host").alias("b_host"), F.col("path").alias("b_path"), "b.rule", "b.verdict").hint("rebalance")
    out = placed.alias("p").join(best.alias("b"), F.expr(f"p.{h} = b.b_host and p.{p} = b.b_path"), "left")
    kept = [F.col(f"p.`{c}`") for c in pages.columns]
    return out.select(*kept, F.col(h).alias("host"), F.col(p).alias("path"), "b.rule", F.coalesce("b.verdict", F.lit(default)).alias("verdict"))


def op1_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return filtered(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
with listed(verdict, host, path) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), cleaned as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), placed as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
  from cleaned
)
select page_id, host, path,
  (select max_by(l.host || l.path, length(l.host || l.path)) from listed l
   where (p.host = l.host or p.host like '%.' || l.host) and starts_with(p.path, l.path)) as rule,
  coalesce((select max_by(l.verdict, length(l.host || l.path)) from listed l
   where (p.host = l.host or p.host like '%.' || l.host) and starts_with(p.path, l.path)), 'allow') as verdict
from placed p
"""
