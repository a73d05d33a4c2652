"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import audit, sample
from millrace.plans.registry import query
from millrace.session import load


@query(
    "a1_content_group",
    "SELECT sha256(text) AS sha, count(*) AS n, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, min(n_chars) = max(n_chars) AS same_size, min(doc_id) AS first_doc FROM documents GROUP BY 1",
)
def a1(spark, d):
    docs = load(spark, d, "documents").select(F.sha2("text", 256).alias("sha"), "source", "n_chars", "doc_id")
    return docs.groupBy("sha").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), (F.min("n_chars") == F.max("n_chars")).alias("same_size"), F.min("doc_id").alias("first_doc"))


@query("a2_group_count", "SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2")
def a2(spark, d):
    return load(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))


@query(
    "a3_two_level_rollup",
    """WITH b AS (SELECT p_type, p_brand, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1, 2)
    SELECT p_type, count(*) AS n_brands, CAST(sum(n) AS BIGINT) AS n_parts, CAST(sum(size) AS BIGINT) AS size, min(lo) AS lo, max(hi) AS hi FROM b GROUP BY 1""",
)
def a3(spark, d):
    b = load(spark, d, "part").groupBy("p_type", "p_brand").agg(F.count("*").alias("n"), F.sum("p_size").alias("s"), F.min("p_retailprice").alias("l"), F.max("p_retailprice").alias("h"))
    return b.groupBy("p_type").agg(F.count("*").alias("n_brands"), F.sum("n").alias("n_parts"), F.sum("s").alias("size"), F.min("l").alias("lo"), F.max("h").alias("hi"))


@query(
    "a4_distinct_by_type",
    """WITH h AS (SELECT lang, sha256(text) AS sha, CAST(substr(source, 4) AS INT) AS s FROM documents)
    SELECT lang, count(*) AS n_raw, count(DISTINCT sha) AS n_unique, count(DISTINCT CASE WHEN s >= 10 THEN sha END) AS n_unique_new FROM h GROUP BY 1""",
)
def a4(spark, d):
    h = load(spark, d, "documents").select("lang", F.sha2("text", 256).alias("sha"), (F.substring("source", 4, 9).cast("int") >= 10).alias("new"))
    one = h.groupBy("lang", "sha").agg(F.count("*").alias("n"), F.bool_or("new").alias("new"))  # one distinct step for all three
    return one.groupBy("lang").agg(F.sum("n").alias("n_raw"), F.count("*").alias("n_unique"), F.sum(F.col("new").cast("long")).alias("n_unique_new"))


@query(
    "a5_first_seen",
    "WITH r AS (SELECT sha256(text) AS sha, doc_id, source, lang, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents) SELECT sha, doc_id, source, lang FROM r WHERE rn = 1",
)
def a5(spark, d):
    docs = load(spark, d, "documents").select(F.sha2("text", 256).alias("sha"), F.struct("doc_id", "source", "lang").alias("s"))
    return docs.groupBy("sha").agg(F.min("s").alias("s")).select("sha", "s.*")


@query(
    "a6_mode_variants",
    """WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS rn, count(*) OVER (PARTITION BY p_brand) AS variants, sum(n) OVER (PARTITION BY p_brand) AS total FROM c)
    SELECT p_brand, p_type AS mode, n AS mode_n, variants, CAST(total AS BIGINT) AS n FROM r WHERE rn = 1""",
)
def a6(spark, d):
    return sample.mode_of(load(spark, d, "part"), ["p_brand"], "p_type")


@query(
    "a7_majority_rule",
    """WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS rn, sum(n) OVER (PARTITION BY p_brand) AS total FROM c)
    SELECT p_brand, p_type AS rule, round(n / total, 4) AS share FROM r WHERE rn = 1 AND total >= 20 AND n / total >= 0.2""",
)
def a7(spark, d):
    return sample.majority_rules(load(spark, d, "part"), ["p_brand"], "p_type", 20, 0.2).withColumn("share", F.round("share", 4))


@query(
    "a8_rank_percentile",
    """WITH r AS (SELECT o_orderstatus, o_totalprice AS v, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) - 1 AS i, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
    SELECT o_orderstatus, max(n) AS n, min(v) FILTER (i = floor(0.05 * (n - 1))) AS p5, min(v) FILTER (i = floor(0.5 * (n - 1))) AS p50, min(v) FILTER (i = floor(0.95 * (n - 1))) AS p95 FROM r GROUP BY 1""",
)
def a8(spark, d):
    return sample.lower_rank(load(spark, d, "orders"), ["o_orderstatus"], "o_totalprice", {"p5": 0.05, "p50": 0.5, "p95": 0.95})


@query(
    "a9_string_agg",
    "SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY o_orderdate, o_orderkey) AS statuses, count(*) AS n FROM orders GROUP BY 1",
)
def a9(spark, d):
    ordered = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")))
    return load(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.transform(ordered, lambda x: x["o_orderstatus"]), ",").alias("statuses"), F.count("*").alias("n"))


@query(
    "a10_combo_flags",
    """WITH f AS (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS f, bool_or(o_orderstatus = 'O') AS o, bool_or(o_orderstatus = 'P') AS p FROM orders GROUP BY 1)
    SELECT concat_ws('+', CASE WHEN f THEN 'F' END, CASE WHEN o THEN 'O' END, CASE WHEN p THEN 'P' END) AS combo, count(*) AS n FROM f GROUP BY 1""",
)
def a10(spark, d):
    flags = load(spark, d, "orders").groupBy("o_custkey").agg(*(F.bool_or(F.col("o_orderstatus") == s).alias(s) for s in "FOP"))
    combo = F.concat_ws("+", *(F.when(F.col(s), s) for s in "FOP"))
    return flags.groupBy(combo.alias("combo")).agg(F.count("*").alias("n"))


@query("a11_cross_dup", "SELECT sha256(text) AS sha, count(*) AS n_rows, count(DISTINCT source) AS n_groups, count(*) - 1 AS extra FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def a11(spark, d):
    return audit.cross_group_copies(load(spark, d, "documents").select(F.sha2("text", 256).alias("sha"), "source"), "sha", "source")


@query(
    "a12_rates",
    """SELECT l_linestatus, count(*) AS n, round(100.0 * count(*) FILTER (l_returnflag = 'R') / nullif(count(*), 0), 2) AS pct_r, round(100.0 * count(*) FILTER (l_returnflag = 'A') / nullif(count(*), 0), 2) AS pct_a,
    round(100.0 * count(*) FILTER (l_discount > 0.05) / nullif(count(*) FILTER (l_returnflag = 'N'), 0), 2) AS pct_d FROM lineitem GROUP BY 1""",
)
def a12(spark, d):
    n = lambda c: F.count(F.when(c, 1))
    flag, many = F.col("l_returnflag"), F.count("*")
    return load(spark, d, "lineitem").groupBy("l_linestatus").agg(many.alias("n"), S.percent(n(flag == "R"), many).alias("pct_r"), S.percent(n(flag == "A"), many).alias("pct_a"), S.percent(n(F.col("l_discount") > 0.05), n(flag == "N")).alias("pct_d"))


@query(
    "a13_family_outlier",
    """WITH b AS (SELECT p_brand, count(*) AS n, avg(p_retailprice) AS m FROM part GROUP BY 1), a AS (SELECT sum(n * m) / sum(n) AS all_m FROM b)
    SELECT p_brand, n, round(m / all_m, 4) AS ratio FROM b, a WHERE n >= 5 AND abs(m / all_m - 1) > 0.001""",
)
def a13(spark, d):
    b = load(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.avg("p_retailprice").alias("m"))
    whole = b.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("all_m"))
    ratio = F.col("m") / F.col("all_m")
    return b.join(F.broadcast(whole)).filter((F.col("n") >= 5) & (F.abs(ratio - 1) > 0.001)).select("p_brand", "n", F.round(ratio, 4).alias("ratio"))


@query(
    "a14_status_rollup",
    """SELECT CAST(date_trunc('day', ts) AS DATE) AS day, count(*) AS jobs, count(*) FILTER (event_type = 'purchase') AS done, count(*) FILTER (event_type = 'error') AS failed,
    count(*) FILTER (event_type IN ('click', 'view')) AS in_flight, round(100.0 * count(*) FILTER (event_type = 'purchase') / count(*), 2) AS pct FROM events GROUP BY 1""",
)
def a14(spark, d):
    n = lambda *k: F.count(F.when(F.col("event_type").isin(*k), 1))
    return load(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("jobs"), n("purchase").alias("done"), n("error").alias("failed"), n("click", "view").alias("in_flight"), S.percent(n("purchase"), F.count("*")).alias("pct"))


@query(
    "a15_histogram",
    """SELECT CASE WHEN n_chars < 100 THEN '0-99' WHEN n_chars < 1000 THEN '100-999' WHEN n_chars < 5000 THEN '1000-4999' WHEN n_chars < 20000 THEN '5000-19999' ELSE '20000+' END AS bin,
    count(*) AS n, min(n_chars) AS lo, round(avg(n_chars), 4) AS mean FROM documents GROUP BY 1""",
)
def a15(spark, d):
    c = F.col("n_chars")
    bin_ = S.first_match([(c < 100, "0-99"), (c < 1000, "100-999"), (c < 5000, "1000-4999"), (c < 20000, "5000-19999")], "20000+")
    return load(spark, d, "documents").groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.min(c).alias("lo"), F.round(F.avg(c), 4).alias("mean"))


@query(
    "a16_status_matrix",
    """WITH e AS (SELECT event_type, user_id % 5 AS g, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT event_type, count(*) FILTER (g = 0) AS g0, count(*) FILTER (g = 1) AS g1, count(*) FILTER (g = 2) AS g2, count(*) FILTER (g = 3) AS g3, count(*) FILTER (g = 4) AS g4,
    min(value) FILTER (i = floor(0.1 * (n - 1))) AS p10, min(value) FILTER (i = floor(0.9 * (n - 1))) AS p90 FROM e GROUP BY 1""",
)
def a16(spark, d):
    ev = load(spark, d, "events").select("event_type", (F.col("user_id") % 5).alias("g"), "value")
    grid = ev.groupBy("event_type").pivot("g", [0, 1, 2, 3, 4]).agg(F.count(F.lit(1)))
    grid = grid.select("event_type", *(F.coalesce(f"`{i}`", F.lit(0)).alias(f"g{i}") for i in range(5)))
    return grid.join(sample.lower_rank(ev, ["event_type"], "value", {"p10": 0.1, "p90": 0.9}).drop("n"), "event_type")


@query(
    "a17_grouped_missing",
    """WITH s AS (SELECT l_orderkey, bool_or(l_linestatus = 'F') AS f, bool_or(l_linestatus = 'O') AS o FROM lineitem GROUP BY 1),
    c AS (SELECT o_orderkey, o_orderpriority, CASE WHEN l_orderkey IS NULL THEN 'source' WHEN NOT o THEN 'only_f' WHEN NOT f THEN 'only_o' END AS cause FROM orders LEFT JOIN s ON l_orderkey = o_orderkey),
    m AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, cause ORDER BY o_orderkey) AS rn FROM c WHERE cause IS NOT NULL),
    g AS (SELECT o_orderpriority, cause, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) FILTER (rn <= 50) AS ids FROM m GROUP BY 1, 2)
    SELECT *, CAST(row_number() OVER (ORDER BY cause = 'source', n DESC, o_orderpriority, cause) AS INT) AS pos FROM g""",
)
def a17(spark, d):
    """Orders that lack lines, by priority and cause: at most 50 ids each, the source's own shortfalls last, the others by size."""
    f, o = F.bool_or(F.col("l_linestatus") == "F"), F.bool_or(F.col("l_linestatus") == "O")
    seen = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(f.alias("f"), o.alias("o"))
    cause = F.when(F.col("f").isNull(), "source").when(~F.col("o"), "only_f").when(~F.col("f"), "only_o")
    rows = load(spark, d, "orders").select("o_orderkey", "o_orderpriority").join(seen, "o_orderkey", "left").withColumn("cause", cause).filter("cause is not null")
    return audit.shortfalls(rows, ["o_orderpriority", "cause"], "o_orderkey", F.col("cause") == "source")


@query(
    "a18_cube",
    "SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS BIGINT) AS level, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)",
)
def a18(spark, d):
    """An extension: the reference has no grouping sets."""
    return load(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.grouping_id().alias("level"), F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query(
    "d1_content_dedup",
    """WITH r AS (SELECT sha256(text) AS sha, doc_id, source, CASE WHEN source = 'src0' THEN 0 ELSE 1 END AS native FROM documents)
    SELECT doc_id, sha, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY sha) AS n_copies, first_value(doc_id) OVER w = doc_id AS kept FROM r WINDOW w AS (PARTITION BY sha ORDER BY native, source, doc_id)""",
)
def d1(spark, d):
    docs = load(spark, d, "documents").select(F.sha2("text", 256).alias("sha"), "doc_id", "source")
    return audit.content_dedup(docs, ["sha"], [(F.col("source") != "src0").cast("int"), F.col("source")], "doc_id").select("doc_id", "sha", "keep_id", "n_copies", "kept")


@query(
    "d2_dedup_dryrun",
    """WITH h AS (SELECT source, CAST(substr(source, 4) AS INT) AS s, sha256(text) AS sha, n_chars FROM documents), f AS (SELECT sha, min(s) AS first FROM h GROUP BY 1)
    SELECT source, count(*) AS n_rows, count(*) FILTER (first < s) AS n_known, CAST(coalesce(sum(n_chars) FILTER (first < s), 0) AS BIGINT) AS known_size FROM h JOIN f USING (sha) GROUP BY 1""",
)
def d2(spark, d):
    h = load(spark, d, "documents").select("source", F.substring("source", 4, 9).cast("int").alias("s"), F.sha2("text", 256).alias("sha"), "n_chars")
    known = h.join(h.groupBy("sha").agg(F.min("s").alias("first")), "sha").withColumn("hit", F.col("first") < F.col("s"))
    return known.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum(F.col("hit").cast("long")).alias("n_known"), F.sum(F.when(F.col("hit"), F.col("n_chars")).otherwise(0)).alias("known_size"))


@query(
    "d3_known_before",
    """WITH b AS (SELECT DISTINCT sha256(lower(text)) AS k FROM benchmark UNION SELECT sha256(lower(text)) FROM documents WHERE source = 'src0')
    SELECT lang, count(*) AS n_rows, count(k) AS n_known, CAST(coalesce(sum(CASE WHEN k IS NOT NULL THEN length(text) END), 0) AS BIGINT) AS known_size FROM conversations_docs LEFT JOIN b ON sha256(lower(text)) = k GROUP BY 1""".replace("conversations_docs", "documents"),
)
def d3(spark, d):
    docs = load(spark, d, "documents").select("lang", "source", "text", F.length("text").cast("long").alias("size"))
    earlier = load(spark, d, "benchmark").select("text").unionByName(docs.filter("source = 'src0'").select("text"))
    return audit.known_before(docs, earlier, F.sha2(F.lower("text"), 256), F.sha2(F.lower("text"), 256), ["lang"], "size")


@query(
    "v1_package_invariants",
    """WITH x AS (SELECT 'size_differs' AS "check", source AS grp, CAST(doc_id AS VARCHAR) AS example FROM documents WHERE n_chars <> length(text)
      UNION ALL SELECT 'duplicate_content', source, CAST(doc_id AS VARCHAR) FROM (SELECT *, count(*) OVER (PARTITION BY source, sha256(text)) AS c FROM documents) WHERE c > 1
      UNION ALL SELECT 'label_missing', source, CAST(doc_id AS VARCHAR) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
      UNION ALL SELECT 'too_short', source, CAST(doc_id AS VARCHAR) FROM documents WHERE n_chars < 50), r AS (SELECT *, row_number() OVER (PARTITION BY "check", grp ORDER BY example) AS rn FROM x)
    SELECT "check", grp, count(*) AS n, string_agg(example, ',' ORDER BY example) FILTER (rn <= 5) AS examples FROM r GROUP BY 1, 2""",
)
def v1(spark, d):
    docs = load(spark, d, "documents")
    copies = docs.select("source", "doc_id", F.sha2("text", 256).alias("sha"))
    many = copies.groupBy("source", "sha").agg(F.count("*").alias("c")).filter("c > 1")
    checks = [
        ("size_differs", docs.filter(F.col("n_chars") != F.length("text"))),
        ("duplicate_content", copies.join(many, ["source", "sha"], "left_semi")),
        ("label_missing", docs.select("source", "doc_id").join(load(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")),
        ("too_short", docs.filter("n_chars < 50")),
    ]
    return audit.invariants(checks, "source", "doc_id", 5)


@query(
    "v2_completeness",
    """SELECT o_orderkey, CASE WHEN x.expected IS NULL THEN 'no_entry' WHEN coalesce(n, 0) = expected THEN 'match' WHEN coalesce(n, 0) > expected THEN 'more' ELSE 'fewer' END AS state
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey LEFT JOIN (SELECT o_orderkey AS k, 4 AS expected FROM orders WHERE o_orderstatus <> 'P') x ON x.k = o_orderkey""",
)
def v2(spark, d):
    n = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    expected = F.when(F.col("o_orderstatus") != "P", F.lit(4))
    out = load(spark, d, "orders").select("o_orderkey", expected.alias("expected")).join(n, "o_orderkey", "left")
    return out.select("o_orderkey", audit.completeness(F.coalesce("n", F.lit(0)), F.col("expected")).alias("state"))


@query(
    "v3_object_audit",
    "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'orphan' ELSE 'stored_ok' END AS state FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id",
)
def v3(spark, d):
    return audit.object_audit(load(spark, d, "documents"), load(spark, d, "labels"), "doc_id")
