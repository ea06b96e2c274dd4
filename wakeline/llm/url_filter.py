"""Operator 6: host and path rules, then mined association rules over URL tokens.

Labelled pages become transactions of URL tokens plus a ``block`` item; Spark's
FP-growth mines the frequent combinations. Rules "tokens => block" survive by
confidence and support. Each rule is filed in an inverted index under its rarest
token; distinct URLs meet the index by that token and are checked for the rest.
Only DataFrame operations and Spark ML are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.tables import stored

BLOCK = "label:block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


HOST_RULES = (
    HostRule("block", "net", "/"),
    HostRule("allow", "example.net", "/en/"),
    HostRule("block", "example.com", "/de/"),
    HostRule("allow", "org", "/fr/"),
)


@dataclass(frozen=True)
class Mining:
    """Pruning bounds of the mined rules.

    ``min_pages`` is an absolute floor of support, so that a handful of labels
    cannot make a rule; above it ``min_support`` (a share of the labelled pages) rules.
    """

    min_confidence: float = 0.6
    min_support: float = 0.002
    min_pages: int = 10


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(url.isNotNull() & (at > 0), F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_struct(host: Column, path: Column, rules: Sequence[HostRule]) -> Column:
    """The longest fitting rule as ``struct(rule, verdict)``; null where none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):  # the last test made is the first one asked
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels, path parts and query parts, digits folded to ``0``."""
    query = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^?#]*(.*)", 1)

    def part(mark: str, text: Column, separators: str) -> Column:
        words = F.filter(F.split(F.translate(text, UPPER, LOWER), separators), lambda w: w != "")
        return F.transform(words, lambda w: F.concat(F.lit(mark), F.regexp_replace(w, "[0-9]+", "0")))

    return F.array_distinct(F.concat(
        part("h:", host, r"[.]"), part("p:", path, "/"), part("q:", F.translate(query, "\n\r", "  "), "[?&=#]")))


def mine_rules(pages: DataFrame, labels: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """``tokens, index_token, confidence, support`` of the rules that block.

    A page is bad when any of its label rows has quality 0 or toxic 1 (null: not bad).
    """
    spark = pages.sparkSession
    bad = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.max(
        F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_bad"))
    known = pages.select(F.col("page_id").alias("_id"), "url", host_of(F.col("url")).alias("_h"),
                         path_of(F.col("url")).alias("_p")).join(bad, "_id")
    transactions = stored(known.select(F.when(
        F.col("_bad"), F.array_append(url_tokens(F.col("url"), F.col("_h"), F.col("_p")), BLOCK),
    ).otherwise(url_tokens(F.col("url"), F.col("_h"), F.col("_p"))).alias("items")), "url-transactions")
    n = transactions.count()
    schema = "tokens array<string>, index_token string, confidence double, support double"
    pages_needed = max(mining.min_pages, ceil(mining.min_support * n))
    if pages_needed > n:
        return spark.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=(pages_needed - 0.5) / n,
                     minConfidence=mining.min_confidence).fit(transactions)
    rules = model.associationRules.where(F.col("consequent")[0] == BLOCK).select(F.col("antecedent").alias("tokens"), "confidence", "support")
    alone = model.freqItemsets.where(F.size("items") == 1).select(
        F.col("items")[0].alias("_token"), F.col("freq").alias("_freq"))
    rarest = (rules.withColumn("_token", F.explode("tokens")).join(alone, "_token")
              .groupBy("tokens", "confidence", "support")
              .agg(F.min(F.struct("_freq", "_token"))["_token"].alias("index_token")))
    return stored(rarest.select("tokens", "index_token", "confidence", "support"), "url-rules")


def matched_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The rows of ``urls(url, tokens)`` that hold all tokens of some rule (once each)."""
    hits = urls.withColumn("_token", F.explode("tokens")).join(
        rules.select(F.col("tokens").alias("_rule"), F.col("index_token").alias("_token")), "_token")
    return hits.where(F.size(F.array_except("_rule", "tokens")) == 0).select("url").distinct()


def url_verdicts(pages: DataFrame, labels: DataFrame, host_rules: Sequence[HostRule] = HOST_RULES,
                 mining: Mining = Mining()) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    The longest fitting host rule decides; else a URL that any mined rule matches
    is blocked, and all others are allowed. URLs are matched once per distinct
    URL, so a URL that many pages share costs one match.

    Defined cases: a null URL or one without ``://`` has an empty host and path and
    is allowed; repeated page rows are judged each; with no labelled page nothing
    is mined; an empty table gives an empty result; other columns are ignored.
    """
    url = F.col("url")
    p = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    p = p.withColumn("_r", rule_struct(F.col("host"), F.col("path"), host_rules))
    open_urls = p.where(F.col("_r").isNull() & url.isNotNull()).select("url", "host", "path").distinct().select(
        "url", url_tokens(url, F.col("host"), F.col("path")).alias("tokens"))
    blocked = matched_urls(open_urls, mine_rules(pages, labels, mining)).withColumn("_blocked", F.lit(True))
    return p.join(blocked, "url", "left").select(
        "page_id", "host", "path", F.col("_r.rule").alias("rule"),
        F.coalesce(F.col("_r.verdict"), F.when(F.col("_blocked"), F.lit("block")), F.lit("allow")).alias("verdict"))


def op6_url_filter(spark, sf_dir):
    return url_verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _op6_sql(m: Mining = Mining()) -> str:
    lowered = f"translate(%s, '{UPPER}', '{LOWER}')"

    def part(mark: str, text: str, separators: str) -> str:
        return (f"list_transform(list_filter(regexp_split_to_array({lowered % text}, '{separators}'), lambda w: w <> ''), "
                f"lambda w: '{mark}' || regexp_replace(w, '[0-9]+', '0', 'g'))")

    rules = sorted(HOST_RULES, key=lambda r: -len(r.name))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in rules]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r.name}'" for f, r in zip(fits, rules)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, rules)) + " END"
    return f"""
WITH rest AS (
  SELECT page_id, url, CASE WHEN url IS NOT NULL AND strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
p AS (
  SELECT page_id, url, {lowered % "regexp_extract(r, '^([^/?#]*)', 1)"} AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(r, '^[^?#]*(.*)', 1) AS query FROM rest),
tok AS (
  SELECT page_id, url, host, path,
         list_distinct(list_concat(list_concat({part('h:', 'host', '[.]')}, {part('p:', 'path', '/')}), {part('q:', 'query', '[?&=#]')})) AS tokens
  FROM p),
bad AS (
  SELECT doc_id, bool_or(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS bad FROM labels GROUP BY doc_id),
known AS (SELECT row_number() OVER () AS k, tokens, bad FROM tok JOIN bad ON page_id = doc_id),
need AS (SELECT greatest({m.min_pages}, ceil({m.min_support} * count(*))) AS pages FROM known),
item AS (SELECT k, bad, unnest(tokens) AS t FROM known),
sets AS (
  SELECT [t] AS s, k, bad FROM item
  UNION ALL SELECT [a.t, b.t], a.k, a.bad FROM item a JOIN item b ON a.k = b.k AND a.t < b.t
  UNION ALL SELECT [a.t, b.t, c.t], a.k, a.bad FROM item a JOIN item b ON a.k = b.k AND a.t < b.t JOIN item c ON a.k = c.k AND b.t < c.t),
rules AS (
  SELECT s FROM sets GROUP BY s
  HAVING count(*) FILTER (bad) >= (SELECT pages FROM need) AND count(*) FILTER (bad) / count(*) >= {m.min_confidence})
SELECT page_id, host, path, {rule} AS rule,
       coalesce({verdict}, CASE WHEN EXISTS (SELECT 1 FROM rules WHERE list_has_all(tokens, s)) THEN 'block' ELSE 'allow' END) AS verdict
FROM tok
"""


OP6_SQL = _op6_sql()
