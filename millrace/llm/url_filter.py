"""URL filters by pattern rules, indexed under each rule's rarest literal token.

A rule is a regular expression with the literal tokens that any URL it fits must hold. Token counts over
all URLs pick the rarest token of each rule; a URL's tokens fetch candidate rules from that index, and only
candidates run their expression. All of it is DataFrame expressions.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased. Path: then up to `?`, `#` or the
end. A null URL, or one without `://`, has both empty, fits no rule, and gets the default verdict. URLs count whole, however long; every
expression takes time in proportion to a URL's length. Rows keep their other columns, whatever their names, but for columns called host, path, rule or
verdict (in any case): the result's take their place. Repeated rows and ties stay as they are (a longer rule wins, then block, then the name). An
empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Up to so many rules the index is a literal in the plan; beyond it, it is a table joined by token.
INLINE_RULES = 256


@dataclass(frozen=True)
class UrlRule:
    name: str
    regex: str
    tokens: tuple[str, ...]
    verdict: str
    #: A named rule decides and is reported; the others are the method's own patterns, which only give a verdict.
    named: bool = True


def host_rule(rule: str, verdict: str) -> UrlRule:
    """`host/path`: fits the host and its subdomains when the URL's path starts with the rule's."""
    host, _, path = rule.partition("/")
    quote = lambda s: re.sub(r"([^A-Za-z0-9/])", r"\\\1", s)
    tokens = re.findall(r"[a-z0-9]+", host.lower())
    pieces = re.split(r"[^A-Za-z0-9]+", path)
    tokens += [p.lower() for p in pieces[:-1] if p]  # the last may go on in a URL
    return UrlRule(rule, rf"^(?:[^/]*\.)?{quote(host)}/{quote(path)}", tuple(dict.fromkeys(tokens)), verdict)


def word_rule(word: str, verdict: str) -> UrlRule:
    """One of the method's own patterns: the word as a whole token of host or path."""
    return UrlRule(word, rf"(?i)(?:^|[^a-z0-9]){word}(?:[^a-z0-9]|$)", (word,), verdict, named=False)


#: The production rules.
RULES = (
    host_rule("net/", "block"),
    host_rule("example.net/en/", "allow"),
    host_rule("example.com/de/", "block"),
    host_rule("org/fr/", "allow"),
)

#: Tokens of hosts and paths that the method blocks where no rule speaks.
WORDS = ("casino", "pills", "porn", "spam", "viagra", "warez", "xxx")


def with_parts(df: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Adds host and path."""
    at = F.locate("://", F.col(url))
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return df.withColumns(
        {
            host: F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower),
            path: F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1),
        }
    )


def tokens_of(key: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(key), "[^a-z0-9]+"), lambda t: t != ""))


def rarest(urls: DataFrame, rules: list[UrlRule]) -> dict[UrlRule, str]:
    """Each rule's token found in the fewest URLs (ties: the longer, then the first in order). One count per rule token comes to the driver."""
    wanted = sorted({t for r in rules for t in r.tokens})
    hits = urls.select(F.explode(F.filter("tokens", lambda t: t.isin(wanted))).alias("t"))
    seen = {x["t"]: x["count"] for x in hits.groupBy("t").count().collect()}
    return {r: min(r.tokens, key=lambda t: (seen.get(t, 0), -len(t), t)) for r in rules}


def _best(hits: Column) -> Column:
    order = lambda r: F.struct(F.length(r["name"]).alias("n"), (r["verdict"] == "block").alias("b"), r["name"].alias("name"), r["verdict"].alias("verdict"))
    return F.array_max(F.transform(hits, order))


def _entry(r: UrlRule) -> Column:
    return F.struct(F.lit(r.regex).alias("regex"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.named).alias("named"))


def filter_urls(pages: DataFrame, rules=RULES, words=WORDS, url: str = "url", default: str = "allow", inline: int = INLINE_RULES) -> DataFrame:
    """`pages` with host, path, rule and verdict."""
    all_rules = [*rules, *(word_rule(w, "block") for w in words)]
    for r in all_rules:
        if not r.tokens:
            raise ValueError(f"rule {r.name} has no literal token to index it by")
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rest = F.struct(*(F.col(f"`{c}`") for c in kept)) if kept else F.lit(None).cast("int")  # names of its own can't clash with the table's
    keyed = with_parts(pages.select(F.col(f"`{url}`").alias("_url"), rest.alias("_rest")), "_url", "_host", "_path").withColumn("_key", F.concat("_host", "_path"))
    by = rarest(keyed.select(tokens_of(F.col("_key")).alias("tokens")), all_rules)
    out = keyed.withColumn("_hits", _inlined(by)) if len(all_rules) <= inline else _joined(keyed, by)
    out = out.withColumn("_best", _best(F.filter("_hits", lambda r: r["named"]))).withColumn("_own", _best(F.filter("_hits", lambda r: ~r["named"])))
    return out.select(
        *(F.col("_rest").getField(c).alias(c) for c in kept),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_best")["name"].alias("rule"),
        F.coalesce(F.col("_best")["verdict"], F.col("_own")["verdict"], F.lit(default)).alias("verdict"),
    )


_HITS = "array<struct<regex:string,name:string,verdict:string,named:boolean>>"


def _inlined(by: dict[UrlRule, str]) -> Column:
    """The hits of the rules that a key's tokens fetch. Each rule's expression is a literal, so it is compiled once a task."""
    index: dict[str, list[UrlRule]] = {}
    for r, t in by.items():
        index.setdefault(t, []).append(r)
    if not index:
        return F.array().cast(_HITS)
    key = F.col("_key")

    def fetched(t):
        out = None
        for token, rs in index.items():
            hits = F.array(*(F.when(F.rlike(key, F.lit(r.regex)), _entry(r)) for r in rs))
            out = F.when(t == token, hits) if out is None else out.when(t == token, hits)
        return out

    found = F.filter(tokens_of(key), lambda t: t.isin(list(index)))
    return F.filter(F.flatten(F.transform(found, fetched)), lambda r: r.isNotNull())


def _joined(keyed: DataFrame, by: dict[UrlRule, str]) -> DataFrame:
    """The same for many rules: distinct keys meet the index by token in a shuffle join, which AQE splits where a token is hot."""
    spark = keyed.sparkSession
    index = spark.createDataFrame([(t, r.regex, r.name, r.verdict, r.named) for r, t in by.items()], "token string, regex string, name string, verdict string, named boolean")
    keys = keyed.select("_key").distinct()
    found = keys.select("_key", F.explode(tokens_of(F.col("_key"))).alias("token")).join(index, "token").filter(F.regexp_like("_key", F.col("regex")))
    hits = found.groupBy("_key").agg(F.collect_set(F.struct("regex", "name", "verdict", "named")).alias("_hits"))
    return keyed.join(hits, "_key", "left").withColumn("_hits", F.coalesce("_hits", F.array().cast(_HITS)))


def op7_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = r"""
WITH a AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), b AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM a
), c AS (
  SELECT *,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM b
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN regexp_matches(lower(host || path), '(^|[^a-z0-9])(casino|pills|porn|spam|viagra|warez|xxx)([^a-z0-9]|$)') THEN 'block'
       ELSE 'allow' END AS verdict
FROM c
"""
