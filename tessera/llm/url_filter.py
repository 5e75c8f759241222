"""URL filters: host-suffix and path-prefix expressions, looked up by short hash prefixes.

A rule is a host, a path and a verdict.  It fits its host and all subdomains when the url's
path starts with the rule's path.  Every distinct (host, path) of the input is expanded into
the expressions that some rule could equal: host suffixes at label borders, down to as many
labels as rules have, times path prefixes of the lengths that rule paths have.  Expressions
meet rules in an equi-join on the first eight hex digits of their SHA-256 and are confirmed on
the full digest.  Of the rules that fit, the one with the longest host + path wins; then the
one with the longer host; then block before allow.

Without a fitting rule the method's own verdict stands: hosts of which one word (labels cut at
hyphens) is in a list of spam and tracking words are blocked through the same lookup, with
expressions made of single words; all others are allowed.

Null urls and urls without ``://`` have an empty host and path; such rows fit no rule and are
allowed.  Repeated rows get the same verdict each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Host words that the method blocks where no rule speaks.
BLOCKED_HOST_WORDS = ("adult", "ads", "casino", "gambling", "malware", "phishing", "pills", "poker", "porn", "spam", "track", "tracker", "tracking", "xxx")

#: (host, path, verdict)
DEFAULT_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Rule tables up to this size are broadcast; larger ones are joined by a shuffle.
BROADCAST_RULE_ROWS = 200_000


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: host with A-Z lower-cased, both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rules_table(spark: SparkSession, rules=DEFAULT_RULES, host_words=BLOCKED_HOST_WORDS) -> DataFrame:
    """Rule rows as (host, path, verdict, kind)."""
    rows = [(h, p, v, "rule") for h, p, v in rules] + [(f"word:{w}", "", "block", "word") for w in host_words]
    return spark.createDataFrame(rows, "host string, path string, verdict string, kind string")


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """All columns of pages (none of them may be called host, path, rule or verdict; such ones are replaced), plus these four."""
    rules = rules.withColumn("expression", F.concat("host", "path")).withColumn("digest", F.sha2("expression", 256)).withColumn("short", F.substring("digest", 1, 8))
    shape = rules.where("kind = 'rule'").agg(F.max(F.size(F.split("host", r"\."))).alias("labels"), F.collect_set(F.length("path")).alias("lengths"), F.count("*").alias("n")).first()  # one row, bounded by distinct path lengths
    host, path = split_url(F.col(url_col))
    base = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    keys = base.select("host", "path").where("host <> ''").distinct()

    labels = F.split("host", r"\.")
    depth = F.least(F.size(labels), F.lit(shape["labels"] or 0))
    suffixes = F.when(depth > 0, F.transform(F.sequence(F.lit(1), depth), lambda k: F.array_join(F.slice(labels, F.size(labels) - k + 1, k), "."))).otherwise(F.array().cast("array<string>"))
    prefixes = F.filter(F.array(*[F.struct(F.lit(n).alias("n"), F.substring("path", 1, n).alias("p")) for n in sorted(shape["lengths"])]), lambda x: F.length(x["p"]) == x["n"]) if shape["lengths"] else F.array().cast("array<struct<n:int,p:string>>")
    words = F.array_distinct(F.split("host", r"[.\-]"))
    expressions = F.concat(
        F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p["p"])))),
        F.transform(words, lambda w: F.concat(F.lit("word:"), w)),
    )
    asked = keys.select("host", "path", F.explode(expressions).alias("asked")).withColumn("asked_digest", F.sha2("asked", 256)).withColumn("short", F.substring("asked_digest", 1, 8)).drop("asked")
    known = rules.select("short", "digest", "kind", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("says"))
    if rules.limit(BROADCAST_RULE_ROWS + 1).count() <= BROADCAST_RULE_ROWS:
        known = F.broadcast(known)
    hits = asked.join(known, "short").where("asked_digest = digest")
    order = F.struct((F.col("kind") == "rule").alias("r"), (F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"), (F.col("says") == "block").alias("b"))
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct("kind", "rule_host", "rule_path", "says"), order).alias("best"))
    out = base.join(best, ["host", "path"], "left")
    rule = F.when(F.col("best.kind") == "rule", F.concat("best.rule_host", "best.rule_path"))
    return out.withColumns({"rule": rule, "verdict": F.coalesce("best.says", F.lit("allow"))}).drop("best")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, rules_table(spark)).select("page_id", "host", "path", "rule", "verdict")


_WORDS = ", ".join(f"'{w}'" for w in BLOCKED_HOST_WORDS)
OP2_SQL = f"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN url IS NOT NULL AND position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages)
), judged AS (
  SELECT page_id, host, path,
    CASE WHEN host = '' THEN NULL
         WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN list_has_any(regexp_split_to_array(host, '[.-]'), [{_WORDS}]) THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
