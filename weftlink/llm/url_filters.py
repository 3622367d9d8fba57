"""URL filters by hashed expressions: native DataFrame operations only.

Each URL is expanded into host-suffix and path-prefix expressions. Expressions meet the rules
in an equi-join on a short prefix of their SHA-256, the full digests confirm the match, and the
longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small, table

#: Hex digits of the digest on which the join runs: 32 bits.
PREFIX_HEX = 8
#: Rule lists up to this many rules are broadcast (about 150 bytes each); longer ones are shuffled.
BROADCAST_RULES = 100_000
#: Copies of a rule in the shuffled join, over which an expression that all URLs share is dealt.
SALTS = 16
#: Shapes of rules (labels and path length) up to this many are joined one after another, without a shuffle.
JOINED_SHAPES = 24
_RANK = "struct<size:int,hosts:int,block:boolean,rule:string,verdict:string>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def split_url(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (with port and user, A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def _digest(host: F.Column, path: F.Column) -> F.Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _expressions(url: str, shapes: list[tuple[int, int]]) -> list[F.Column]:
    """Digests of the URL's host suffix of k labels with its path prefix of p characters, null where it is shorter."""
    host, path = split_url(F.col(url))
    labels = F.split(host, r"\.")
    fits = lambda k, p: (F.size(labels) >= k) & (F.length(path) >= p)
    return [F.when(fits(k, p), _digest(F.array_join(F.slice(labels, F.size(labels) - k + 1, F.lit(k)), "."), F.substring(path, 1, p))) for k, p in shapes]


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url", broadcast_rules: int = BROADCAST_RULES, joined_shapes: int = JOINED_SHAPES) -> DataFrame:
    """``urls`` with host, path, rule and verdict added.

    ``rules``: host, path, verdict. A rule fits its host and all subdomains if the URL's path
    starts with the rule's path. Of fitting rules the longest (host and path together) wins,
    then the longer host, then block over allow. Only suffixes with as many labels, and
    prefixes as long, as some rule has are expanded, so a URL makes at most as many expressions
    as there are rule shapes. Null and malformed URLs have an empty host and path, fit no rule
    and get ``default``; repeated rows are judged one by one; a rule with a null or empty host is
    ignored; empty tables are fine. Columns of ``urls`` called host, path, rule or verdict are replaced.

    The join is on the digest's prefix alone, with the rules of a prefix in one row; the full
    digests confirm after it. Few rules of few shapes are joined shape by shape, and no URL is
    shuffled. Else the expressions of distinct URLs are, and what they found is joined back.
    """
    own = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    clean = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host <> ''").distinct()
    clean = clean.select("*", F.size(F.split("host", r"\.")).alias("k"), F.length("path").alias("p"))
    shapes = sorted((r.k, r.p) for r in clean.select("k", "p").distinct().collect())  # at most labels x path lengths of a rule
    rank = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("hosts"), (F.col("verdict") == "block").alias("block"), F.concat("host", "path").alias("rule"), F.col("verdict"))
    held = clean.select(_digest(F.col("host"), F.col("path")).alias("full"), rank.alias("rank"))
    held = held.groupBy(F.substring("full", 1, PREFIX_HEX).alias("__start")).agg(F.collect_list(F.struct("full", "rank")).alias("__rules"))
    confirmed = lambda digest: F.array_max(F.transform(F.filter("__rules", lambda r: r["full"] == digest), lambda r: r["rank"]))
    few = clean.count() <= broadcast_rules
    host, path = split_url(F.col(url))
    result = [host.alias("host"), path.alias("path"), F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict")]

    if few and len(shapes) <= joined_shapes:
        met = urls.select(*own, F.lit(None).cast(_RANK).alias("__best"), *[d.alias(f"__d{i}") for i, d in enumerate(_expressions(url, shapes))])
        for i in range(len(shapes)):
            met = met.join(F.broadcast(held), F.substring(f"__d{i}", 1, PREFIX_HEX) == F.col("__start"), "left")
            met = met.withColumn("__best", F.greatest(F.col("__best"), confirmed(F.col(f"__d{i}")))).drop("__start", "__rules", f"__d{i}")
        return met.select(*own, *result)

    asked = urls.select(F.col(url).alias("__url")).distinct().select("__url", F.explode(F.array_compact(F.array(*_expressions("__url", shapes)))).alias("__digest"))
    prefix = F.substring("__digest", 1, PREFIX_HEX)
    if few:
        met = asked.join(F.broadcast(held), prefix == F.col("__start"), "left")
    else:
        held = held.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = F.pmod(F.xxhash64("__url"), F.lit(SALTS)).cast("int")
        met = asked.join(held, (prefix == F.col("__start")) & (dealt == F.col("__salt")), "left")
    best = met.groupBy("__url").agg(F.max(confirmed(F.col("__digest"))).alias("__best")).where("__best is not null")
    return urls.join(small(best), F.col(url) == F.col("__url"), "left").select(*own, *result)


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict; see ``judge`` for null and odd URLs, repeated rows and empty tables."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
rules(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
met AS (
  SELECT p.page_id, p.host, p.path, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC, rverdict DESC) AS n
  FROM parts p LEFT JOIN rules ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM met WHERE n = 1
"""
