"""URL filters by a sort-merge range join, in DataFrame functions only.

A host becomes its labels in reverse, each followed by a dot ("www.example.com" gives
"com.example.www."), so a rule's host and all its subdomains are exactly the keys in
[key, key with its last dot raised to a slash); hosts hold no slash.  Rule intervals therefore
nest or are disjoint.  A sweep over rule bounds and distinct hosts in key order hands each
host the stack of the rules that are open at it; the url's path then picks the longest fit.

Skew: the sweep sees each distinct host once (a hot host is one row), dealt by top-level label
and a salt; rule bounds are copied to each salt.  Verdicts return by an equi-join on the host,
which adaptive execution can split.

Defined cases: null urls and urls without "://" have an empty host and path and get the default
verdict; repeated rows stay; of equal rules one stays, block before allow; an empty table gives no
rows; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed values of the query: (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", 2), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, host string, path string")


def rule_segments(rules: DataFrame) -> DataFrame:
    """Elementary segments of the host line: at each bound, the stack of the rules open from there on.

    Columns: key, stack (array of struct(len, verdict, path, rule)), longest first.
    """
    r = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select("verdict", "host", "path", host_key(F.col("host")).alias("lo"), F.concat("host", "path").alias("rule"))
    r = r.withColumn("hi", F.concat(F.expr("substring(lo, 1, length(lo) - 1)"), F.lit("/")))
    bounds = r.select(F.col("lo").alias("key"), "host").unionByName(r.select(F.col("hi").alias("key"), F.expr("substring(host, instr(host, '.') + 1)").alias("host"))).dropDuplicates(["key"])
    # Open at a bound are the rules of its host's suffixes; at an end, only those of the parent's.
    up = bounds.select("key", F.explode(F.expr("transform(sequence(1, size(split(host, '\\\\.'))), i -> array_join(slice(split(host, '\\\\.'), i, size(split(host, '\\\\.'))), '.'))")).alias("host"))
    held = up.join(r.select("host", "verdict", "path", "rule", "lo", "hi"), "host").where((F.col("lo") <= F.col("key")) & (F.col("key") < F.col("hi")))
    stacks = held.groupBy("key").agg(F.sort_array(F.collect_list(F.struct(F.length("rule").alias("len"), "verdict", "path", "rule")), asc=False).alias("stack"))
    return bounds.select("key").join(stacks, "key", "left")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", salts: int = 64) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages."""
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = p.groupBy("host").agg(F.lit(1).alias("one")).select("host", host_key(F.col("host")).alias("key"))
    tld = F.substring_index("key", ".", 1)
    points = hosts.select("key", "host", tld.alias("tld"), F.pmod(F.xxhash64("host"), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("point"), F.lit(None).cast("array<struct<len:int,verdict:string,path:string,rule:string>>").alias("stack"))
    seg = rule_segments(rules).select("key", F.lit(None).cast("string").alias("host"), F.regexp_extract("key", r"^([^./]*)", 1).alias("tld"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("point"), F.coalesce("stack", F.array().cast("array<struct<len:int,verdict:string,path:string,rule:string>>")).alias("stack"))
    sweep = Window.partitionBy("tld", "salt").orderBy("key", "point").rowsBetween(Window.unboundedPreceding, 0)
    swept = points.unionByName(seg).withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("point = 1").select("host", "open")
    best = F.expr("try_element_at(filter(open, r -> startswith(path, r.path)), 1)")
    return p.join(swept, "host", "left").withColumn("best", best).select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark))



OP4_SQL = """
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r(verdict, rhost, rpath) AS (VALUES ('allow','com','/'),('block','example.com','/en/'),('allow','www.example.com','/en/'),('block','net','/es/'),('block','net','/fr/')),
m AS (
  SELECT p.page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS verdict
  FROM p JOIN r ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)
  GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id
"""
