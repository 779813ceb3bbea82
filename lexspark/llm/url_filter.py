"""Operator 5, URL filters: a blocked Bloom filter in front of an exact hash join, in DataFrame functions only.

A listed rule is a host and a path; it fits that host and its subdomains where the url's path starts with the rule's.
It is found in two steps. Every url gives the suffixes of its host, of as many labels as the longest listed host has at
most; those that pass a filter of the listed hosts are made distinct and meet the hosts, each of which names the lengths of its
paths. Prefixes of the url's path of these lengths make keys; those that pass a filter of the listed keys go on to an
equality join with them, which removes the filter's false positives. The plan is of one size whatever the list holds, and urls
that no listed host fits move nowhere. In a filter a key's hash chooses one block of eight 32-bit words and one bit in each
word. The longest rule wins (then the longer host). A filter has at most MAX_BLOCKS blocks of 40 bytes, so it may be broadcast whatever the
list's size: a longer list makes more false positives, no wrong answers. Urls with a rule are written before pages are
joined with them: few are broadcast by their size as Spark finds it, many let Spark split a url of many pages.

Null url or one without `://`: empty host and path, no rule, the default verdict. Rules with null parts are dropped,
of equal rules the first verdict in order counts. Repeated pages each get a row. An empty table gives an empty
result; an empty list gives every url the default verdict. Extra columns are kept by `judge`; columns named as its own
(host, path, rule, verdict, in any case) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexspark.llm.common import materialize, unused

MAX_BLOCKS = 1 << 16
BITS_PER_KEY = 16
# fixed values: odd multipliers that spread a hash over the eight words
SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)

# fixed values: the rules of op5
OP5_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def _rest(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"^(?s:.*?)://((?s:.*))$", 1)).otherwise("")


def canonical_host(url: Column) -> Column:
    host = F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def canonical_path(url: Column) -> Column:
    return F.regexp_extract(_rest(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(key), 32), F.lit(blocks)).cast("int")


def _mask(key: Column, k: int) -> Column:
    """The bit of word k: five high bits of 31 bits of the hash times a salt."""
    low = F.xxhash64(key).bitwiseAND(F.lit(0x7FFFFFFF))
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned((low * SALTS[k]).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int"))


def blocked_bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """block and words w0..w7 of a filter of the column `key`; blocks without keys have no row."""
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(*[F.bit_or(_mask(F.col("key"), k)).alias(f"w{k}") for k in range(8)])


def maybe_listed(rows: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows whose `key` passes the filter."""
    hit = F.lit(True)
    for k in range(8):
        hit = hit & (F.col(f"w{k}").bitwiseAND(_mask(F.col("key"), k)) != 0)
    # at most MAX_BLOCKS rows of nine numbers
    return rows.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(bloom), "block").where(hit).select(*rows.columns)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """pages with host, path, rule and verdict. rules: host, path, verdict."""
    key = lambda host, path: F.concat(F.length(host).cast("string"), F.lit(":"), host, path)
    rules = rules.where("host <> '' and path is not null and verdict is not null")
    rules = rules.groupBy(key(F.col("host"), F.col("path")).alias("key"), "host", F.concat("host", "path").alias("rule"), F.length("path").alias("chars")).agg(F.min("verdict").alias("verdict"))
    hosts = materialize(rules.groupBy(F.col("host").alias("key")).agg(F.collect_set("chars").alias("lengths"), F.count("*").alias("n")), "hosts", "uncompressed")
    found = hosts.agg(F.count("*").alias("hosts"), F.sum("n").alias("rules"), F.max(F.size(F.split("key", r"\.", -1))).alias("labels")).first()
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = [canonical_host(F.col(url_col)).alias("host"), canonical_path(F.col(url_col)).alias("path")]
    if not found["hosts"]:
        return pages.select(*kept, *parts, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    blocks = lambda n: min(MAX_BLOCKS, max(1, -(-n * BITS_PER_KEY // 256)))
    of_hosts, of_keys = blocks(found["hosts"]), blocks(found["rules"])
    urls = pages.select(F.col(url_col).alias("url"), canonical_host(F.col(url_col)).alias("h")).where("h <> ''")
    names = F.sequence(F.lit(1), F.least(F.size(F.split("h", r"\.", -1)), F.lit(found["labels"])))
    ends = urls.select("url", F.explode(names).alias("n"), "h").select("url", F.call_function("substring_index", F.col("h"), F.lit("."), -F.col("n")).alias("key"))
    near = maybe_listed(ends, blocked_bloom(hosts, of_hosts), of_hosts).distinct().join(hosts.select("key", "lengths"), "key")
    near = near.withColumn("p", canonical_path(F.col("url"))).select("url", "p", F.col("key").alias("h"), F.explode("lengths").alias("c")).where("length(p) >= c")
    possible = maybe_listed(near.select("url", key(F.col("h"), F.substring("p", F.lit(1), F.col("c"))).alias("key")), blocked_bloom(rules, of_keys), of_keys)
    hits = possible.join(rules, "key")
    best = hits.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), F.length("host").alias("m"), "rule", "verdict")).alias("b"))
    at, rule, verdict = unused(pages, "listed_url", "listed_rule", "listed_verdict")
    best = materialize(best.select(F.col("url").alias(at), F.col("b.rule").alias(rule), F.col("b.verdict").alias(verdict)), "listed", "uncompressed")
    out = pages.join(best, F.col(url_col) == F.col(at), "left")
    return out.select(*kept, *parts, F.col(rule).alias("rule"), F.coalesce(F.col(verdict), F.lit(default)).alias("verdict"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(OP5_RULES, "host string, path string, verdict string")
    return judge(pages, rules).drop("url")


OP5_SQL = """
WITH rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
hits AS (SELECT p.page_id, max({'n': length(r.host || r.path), 'rule': r.host || r.path, 'verdict': r.verdict}) AS b
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.page_id)
SELECT p.page_id, p.host, p.path, h.b.rule AS rule, coalesce(h.b.verdict, 'allow') AS verdict FROM parts p LEFT JOIN hits h USING (page_id)
"""
