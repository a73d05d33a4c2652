"""Scans, predicates, joins and resolution."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import audit, graph, match, resolve
from millrace.operators.order import ranked
from millrace.plans.registry import query
from millrace.session import load
from millrace.sources import io

#: Part type to category, Other where there is none.
PART_CATEGORY = {"STANDARD": "stock", "SMALL": "stock", "MEDIUM": "stock", "LARGE": "bulk", "ECONOMY": "bulk", "PROMO": "campaign"}


@query("s1_scan_filter", "SELECT doc_id, source, lang, n_chars FROM documents WHERE n_chars > 0")
def s1(spark, d):
    return load(spark, d, "documents").filter("n_chars > 0").select("doc_id", "source", "lang", "n_chars")


@query("s2_prefilter_json", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE regexp_matches(props, '\"k\": [0-9]')")
def s2(spark, d):
    rows = io.prefiltered_json(load(spark, d, "events").select("event_id", "event_type", "props"), "props", '"k": [0-9]', "k long")
    return rows.select("event_id", "event_type", "j.k")


@query(
    "p1_ext_norm",
    r"""
    WITH b AS (SELECT page_id, lower(split_part(regexp_replace(url, '[?#].*$', ''), '/', -1)) AS base FROM pages),
    e AS (SELECT page_id, base, split_part(base, '.', -1) AS ext FROM b)
    SELECT page_id, CASE WHEN NOT contains(base, '.') THEN '(none)'
      WHEN length(ext) > 12 OR NOT regexp_matches(ext, '^[0-9a-z_]*[0-9a-z][0-9a-z_]*$') THEN '(other)'
      WHEN regexp_matches(ext, '^[jmp][0-9]{3}$') THEN ext[1] || '###' WHEN starts_with(ext, 'p_') THEN 'p_*' ELSE ext END AS ext FROM e
    """,
)
def p1(spark, d):
    return load(spark, d, "pages").select("page_id", S.ext_norm(F.regexp_replace("url", "[?#].*$", "")).alias("ext"))


@query("p2_category_map", "SELECT CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 'stock' WHEN 'SMALL' THEN 'stock' WHEN 'MEDIUM' THEN 'stock' WHEN 'LARGE' THEN 'bulk' WHEN 'ECONOMY' THEN 'bulk' WHEN 'PROMO' THEN 'campaign' ELSE 'Other' END AS category, count(*) AS n_parts, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY 1")
def p2(spark, d):
    pairs = F.create_map(*(F.lit(x) for kv in PART_CATEGORY.items() for x in kv))
    cat = F.coalesce(F.element_at(pairs, F.split("p_type", " ")[0]), F.lit("Other"))
    return load(spark, d, "part").groupBy(cat.alias("category")).agg(F.count("*").alias("n_parts"), F.sum("p_size").alias("size"))


@query(
    "p3_rule_cascade",
    r"""SELECT doc_id, CASE WHEN n_chars >= 5000 THEN 'large' WHEN regexp_matches(text, '[Ll]icense') THEN 'license' WHEN regexp_matches(text, '[#*$%&]{3}') THEN 'symbols'
    WHEN regexp_matches(text, '\| [A-Za-z]+ \|') THEN 'table' WHEN regexp_matches(text, '@[a-z]+\.') THEN 'contact' ELSE 'unknown' END AS kind FROM documents""",
)
def p3(spark, d):
    t = F.col("text")
    rules = [(F.col("n_chars") >= 5000, "large"), *((F.rlike(t, F.lit(p)), k) for p, k in (("[Ll]icense", "license"), ("[#*$%&]{3}", "symbols"), (r"\| [A-Za-z]+ \|", "table"), (r"@[a-z]+\.", "contact")))]
    return load(spark, d, "documents").select("doc_id", S.first_match(rules, "unknown").alias("kind"))


@query(
    "p4_coalesce_chain",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice, round(coalesce(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END, CASE WHEN l_discount > 0.05 THEN l_extendedprice * (1 - l_discount) END,
    CASE WHEN p_retailprice > 0 THEN l_quantity * p_retailprice END, 0.0), 4) AS best FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def p4(spark, d):
    line, part = load(spark, d, "lineitem"), load(spark, d, "part").select("p_partkey", "p_retailprice")
    c = F.col
    best = F.coalesce(F.when(c("l_returnflag") == "R", c("l_extendedprice")), F.when(c("l_discount") > 0.05, c("l_extendedprice") * (1 - c("l_discount"))), F.when(c("p_retailprice") > 0, c("l_quantity") * c("p_retailprice")), F.lit(0.0))
    return line.join(part, c("l_partkey") == c("p_partkey"), "left").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice", F.round(best, 4).alias("best"))


@query(
    "j1_inner_star",
    "SELECT n_name, o_orderstatus, count(*) AS n_lines, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2",
)
def j1(spark, d):
    line = load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    orders, cust, nation = load(spark, d, "orders"), load(spark, d, "customer"), load(spark, d, "nation")
    out = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(cust, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return out.groupBy("n_name", "o_orderstatus").agg(F.sum("n").alias("n_lines"), F.round(F.sum("r"), 2).alias("revenue"))


@query("j2_left_lookup", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic, l.doc_id IS NOT NULL AS labelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def j2(spark, d):
    labels = load(spark, d, "labels").withColumn("labelled", F.lit(True))
    out = load(spark, d, "documents").select("doc_id").join(labels, "doc_id", "left")
    return out.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic"), F.coalesce("labelled", F.lit(False)).alias("labelled"))


def _is_f():
    return F.when(F.col("l_linestatus") == "F", True).when(F.col("l_linestatus") == "O", False)


def _sides(spark, d):
    line = load(spark, d, "lineitem")
    return line.filter("l_linestatus = 'F'"), line.filter("l_linestatus = 'O'")


@query(
    "j3_full_outer_recon",
    """WITH k AS (SELECT l_partkey, bool_or(l_linestatus = 'F') AS f, bool_or(l_linestatus = 'O') AS o FROM lineitem GROUP BY 1)
    SELECT p_partkey AS l_partkey, CASE WHEN f AND o THEN 'both' WHEN f THEN 'only_left' ELSE 'only_right' END AS status FROM part JOIN k ON p_partkey = l_partkey""",
)
def j3(spark, d):
    return match.reconcile_within(load(spark, d, "lineitem").select("l_partkey", "l_linestatus"), ["l_partkey"], _is_f())


def _edges(spark, d):
    cust, nation = load(spark, d, "customer"), load(spark, d, "nation")
    edge = lambda df, s, p, t, q, rel: df.select(F.concat(F.lit(p), F.col(s).cast("string")).alias("src"), F.concat(F.lit(q), F.col(t).cast("string")).alias("dst"), F.lit(rel).alias("rel"))
    return (
        edge(cust, "c_custkey", "c", "c_nationkey", "n", "lives_in")
        .unionByName(edge(nation, "n_nationkey", "n", "n_regionkey", "r", "part_of"))
        .unionByName(edge(load(spark, d, "supplier"), "s_suppkey", "s", "s_nationkey", "n", "based_in"))
        .unionByName(edge(load(spark, d, "orders"), "o_orderkey", "o", "o_custkey", "c", "placed_by"))
    )


_EDGES = """WITH e AS (SELECT 'c' || c_custkey AS src, 'n' || c_nationkey AS dst, 'lives_in' AS rel FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'part_of' FROM nation
    UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, 'based_in' FROM supplier UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, 'placed_by' FROM orders)"""


@query("j4_two_hop", _EDGES + "SELECT b.dst, count(*) AS n_paths, count(DISTINCT a.dst) AS n_mid FROM e a JOIN e b ON a.dst = b.src WHERE a.rel = 'lives_in' AND b.rel = 'part_of' GROUP BY 1")
def j4(spark, d):
    return graph.two_hops(_edges(spark, d), "lives_in", "part_of").groupBy("dst").agg(F.count("*").alias("n_paths"), F.countDistinct("mid").alias("n_mid"))


@query(
    "j11_neighbourhood",
    _EDGES + "SELECT 'out' AS direction, rel, count(*) AS n, min(dst) AS sample, count(DISTINCT dst) AS n_nodes FROM e GROUP BY 2 UNION ALL SELECT 'in', rel, count(*), min(src), count(DISTINCT src) FROM e GROUP BY 2",
)
def j11(spark, d):
    return graph.neighbourhood(_edges(spark, d))


@query("j5_semi", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def j5(spark, d):
    return load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").join(load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")


@query("j6_anti", "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def j6(spark, d):
    return load(spark, d, "orders").select("o_orderkey", "o_custkey").join(load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query(
    "j7_priority_resolve",
    """WITH w AS (SELECT DISTINCT sha256(text) AS sha FROM documents), t AS (
      SELECT sha256(d.text) AS sha, 0 AS rank, 'labelled' AS how, min(CAST(d.doc_id AS VARCHAR)) AS loc FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1 GROUP BY 1
      UNION ALL SELECT sha256(text), 1, 'benchmark', min('b' || item_id) FROM benchmark GROUP BY 1
      UNION ALL SELECT sha256(text), 2, 'low_source', min(CAST(doc_id AS VARCHAR)) FROM documents WHERE source IN ('src0', 'src1', 'src2', 'src3', 'src4') GROUP BY 1),
    b AS (SELECT *, row_number() OVER (PARTITION BY sha ORDER BY rank, loc) AS rn FROM t)
    SELECT w.sha, b.loc, coalesce(b.how, 'unresolved') AS how FROM w LEFT JOIN b ON w.sha = b.sha AND rn = 1""",
)
def j7(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "source", F.sha2("text", 256).alias("sha"))
    loc = docs.withColumn("loc", F.col("doc_id").cast("string"))
    good = load(spark, d, "labels").filter("quality = 1").select("doc_id")
    bench = load(spark, d, "benchmark").select(F.sha2("text", 256).alias("sha"), F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("loc"))
    tiers = [("labelled", loc.join(good, "doc_id", "left_semi")), ("benchmark", bench), ("low_source", loc.filter(F.col("source").isin(*(f"src{i}" for i in range(5)))))]
    return resolve.priority_resolve(docs.select("sha").distinct(), "sha", tiers, "loc").select("sha", "loc", "how")


@query(
    "j8_proof_gate",
    """WITH o AS (SELECT DISTINCT n_chars AS size, sha256(text) AS sha FROM documents), b AS (
      SELECT item_id AS id, length(text) AS size, sha256(text) AS sha FROM benchmark UNION ALL SELECT -1 - doc_id, n_chars, sha256(text) FROM documents)
    SELECT b.id, CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.size = b.size AND o.sha = b.sha) THEN 'proven' WHEN EXISTS (SELECT 1 FROM o WHERE o.size = b.size) THEN 'proof_differs' ELSE 'no_candidate' END AS reason FROM b""",
)
def j8(spark, d):
    docs = load(spark, d, "documents")
    proof = F.sha2("text", 256).alias("sha")
    offers = docs.select(F.col("n_chars").alias("size"), proof)
    asks = load(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.length("text").cast("long").alias("size"), proof)
    asks = asks.unionByName(docs.select((-1 - F.col("doc_id")).alias("id"), F.col("n_chars").alias("size"), proof))
    return resolve.proof_gate(asks, offers, ["size"], "sha").select("id", "reason")


@query(
    "j9_ambiguous_lookup",
    """WITH c AS (SELECT p_name, count(*) AS n, min(p_partkey) AS one, min(CASE WHEN p_size = 1 THEN p_partkey END) AS exact FROM part GROUP BY 1)
    SELECT a.p_partkey, CASE WHEN n IS NULL THEN 'not_found' WHEN n = 1 THEN 'unique' WHEN exact IS NOT NULL THEN 'exact' ELSE 'ambiguous' END AS status,
      CASE WHEN n = 1 THEN CAST(one AS VARCHAR) WHEN n > 1 THEN CAST(exact AS VARCHAR) END AS choice, coalesce(n, 0) AS candidates FROM part a LEFT JOIN c ON c.p_name = a.p_name""",
)
def j9(spark, d):
    part = load(spark, d, "part").select("p_partkey", "p_name", "p_size")
    exact = part.filter("p_size = 1").groupBy("p_name").agg(F.min("p_partkey").cast("string").alias("exact"))
    asks = part.select("p_partkey", "p_name").join(exact, "p_name", "left")
    offers = part.select("p_name", F.col("p_partkey").alias("offer"))
    out = resolve.ambiguous_lookup(asks, offers, "p_name", "offer", F.col("exact"))
    return out.select("p_partkey", "status", F.col("choice").cast("string").alias("choice"), "candidates")


@query("j10_scalar_subquery", "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders FROM customer")
def j10(spark, d):
    return spark.sql("SELECT c_custkey, (SELECT count(*) FROM {orders} WHERE o_custkey = c_custkey) AS n_orders FROM {customer}", orders=load(spark, d, "orders"), customer=load(spark, d, "customer"))


@query(
    "j12_lateral_top1",
    "SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) ON o_custkey = c_custkey AND rn = 1",
)
def j12(spark, d):
    orders = load(spark, d, "orders").select("o_custkey", F.struct("o_orderdate", (-F.col("o_orderkey")).alias("k"), "o_totalprice").alias("s"))
    top = orders.groupBy("o_custkey").agg(F.max("s").alias("s"))  # the first by date, without a sort of each customer's orders
    out = load(spark, d, "customer").select("c_custkey").join(top, F.col("c_custkey") == F.col("o_custkey"), "left")
    return out.select("c_custkey", (-F.col("s.k")).alias("o_orderkey"), "s.o_totalprice")


@query(
    "j13_prefix_semi",
    """WITH h AS (SELECT doc_id, source, CAST(substr(source, 4) AS INT) AS s, substr(sha256(text), 1, 16) AS pre, sha256(text) AS sha FROM documents)
    SELECT doc_id, source FROM h WHERE EXISTS (SELECT 1 FROM h e WHERE e.pre = h.pre AND e.sha = h.sha AND e.s < h.s)""",
)
def j13(spark, d):
    h = load(spark, d, "documents").select("doc_id", "source", F.substring("source", 4, 9).cast("int").alias("s"), S.sha_prefix(F.col("text")).alias("pre"), F.sha2("text", 256).alias("sha"))
    first = h.groupBy("pre", "sha").agg(F.min("s").alias("first"))  # the prefix finds, the whole hash confirms
    return h.join(first, ["pre", "sha"]).filter("first < s").select("doc_id", "source")


_ORDER = "l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate"
_LINE = [c.strip() for c in _ORDER.split(",")]


@query(
    "j14_bag_match",
    f"""WITH n AS (SELECT l_partkey, l_linestatus, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey, l_linestatus ORDER BY {_ORDER}) AS rn FROM lineitem)
    SELECT coalesce(f.l_partkey, o.l_partkey) AS l_partkey, CAST(coalesce(f.rn, o.rn) AS INT) AS rn, f.l_orderkey AS f_order, o.l_orderkey AS o_order
    FROM (SELECT * FROM n WHERE l_linestatus = 'F') f FULL JOIN (SELECT * FROM n WHERE l_linestatus = 'O') o ON f.l_partkey = o.l_partkey AND f.rn = o.rn""",
)
def j14(spark, d):
    f, o = (x.select("l_partkey", *_LINE) for x in _sides(spark, d))
    return match.bag_match(f, o, ["l_partkey"], _LINE, _LINE).select("l_partkey", "rn", F.col("l.l_orderkey").alias("f_order"), F.col("r.l_orderkey").alias("o_order"))


_PAIRS = f"""WITH c AS (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_linestatus = 'F') = count(*) FILTER (l_linestatus = 'O')),
    n AS (SELECT l_partkey, l_linestatus, l_extendedprice, row_number() OVER (PARTITION BY l_partkey, l_linestatus ORDER BY l_extendedprice, {_ORDER.replace('l_extendedprice, ', '')}) AS rn FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM c)),
    p AS (SELECT f.l_partkey, CAST(f.rn AS INT) AS rn, f.l_extendedprice AS f_price, o.l_extendedprice AS o_price FROM n f JOIN n o ON f.l_partkey = o.l_partkey AND f.rn = o.rn WHERE f.l_linestatus = 'F' AND o.l_linestatus = 'O')"""


def sorted_price_pairs(spark, d):
    order = ["l_extendedprice", *(c for c in _LINE if c != "l_extendedprice")]
    line = load(spark, d, "lineitem").select("l_partkey", "l_linestatus", *_LINE)
    return match.sorted_pairs_within(line, ["l_partkey"], _is_f(), order).select("l_partkey", "rn", F.col("l.l_extendedprice").alias("f_price"), F.col("r.l_extendedprice").alias("o_price"))


@query("j15_sorted_pairing", _PAIRS + "SELECT * FROM p")
def j15(spark, d):
    return sorted_price_pairs(spark, d)


@query(
    "j16_sibling_dirs",
    r"""WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS u FROM pages), q AS (SELECT page_id, regexp_replace(u, '/[^/]*$', '') AS dir FROM p)
    SELECT a.page_id, 'same' AS scope, count(*) AS n_peers, min(b.page_id) AS first_peer FROM q a JOIN q b ON a.dir = b.dir GROUP BY 1
    UNION ALL SELECT a.page_id, 'parent', count(*), min(b.page_id) FROM q a JOIN q b ON regexp_replace(a.dir, '/[^/]*$', '') = b.dir GROUP BY 1""",
)
def j16(spark, d):
    pages = load(spark, d, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("url"))
    # Folders are counted before they meet their pages, so a folder with many pages makes no pairs.
    dirs = pages.groupBy(resolve.parent_of(F.col("url")).alias("dir")).agg(F.count("*").alias("n_peers"), F.min("page_id").alias("first_peer"))
    here = resolve.parent_of(F.col("url"))
    asks = pages.select("page_id", F.explode(F.array(F.struct(F.lit("same").alias("scope"), here.alias("dir")), F.struct(F.lit("parent").alias("scope"), resolve.parent_of(here).alias("dir")))).alias("a")).select("page_id", "a.scope", "a.dir")
    return asks.join(dirs, "dir").select("page_id", "scope", "n_peers", "first_peer")


@query(
    "j17_canon_key_join",
    r"""WITH k AS (SELECT page_id, regexp_replace(lower(regexp_replace(regexp_replace(url, '^[a-z]+://(www\.|m\.|blog\.)?', ''), '[?#].*$', '')), '[^a-z0-9]', '', 'g') AS key FROM pages)
    SELECT key, count(*) AS n_pages, min(page_id) AS first_page, max(page_id) AS last_page FROM k GROUP BY 1 HAVING count(*) > 1""",
)
def j17(spark, d):
    bare = F.regexp_replace(F.regexp_replace("url", r"^[a-z]+://(www\.|m\.|blog\.)?", ""), "[?#].*$", "")
    return load(spark, d, "pages").groupBy(S.canon_key(bare).alias("key")).agg(F.count("*").alias("n_pages"), F.min("page_id").alias("first_page"), F.max("page_id").alias("last_page")).filter("n_pages > 1")


@query("u1_union_distinct", "SELECT o_custkey AS custkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def u1(spark, d):
    a = load(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey"))
    return a.union(load(spark, d, "customer").filter("c_acctbal < 0").select("c_custkey")).distinct()


@query(
    "u2_two_way_diff",
    "SELECT o_orderkey AS orderkey, 'no_line' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT DISTINCT l_orderkey, 'no_order' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)",
)
def u2(spark, d):
    return audit.two_way_diff(load(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey")), load(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey")), ["orderkey"], ("no_line", "no_order"))


@query("u3_except_all", "SELECT l_returnflag, l_linenumber FROM lineitem WHERE l_linestatus = 'F' EXCEPT ALL SELECT l_returnflag, l_linenumber FROM lineitem WHERE l_linestatus = 'O'")
def u3(spark, d):
    f, o = _sides(spark, d)
    return f.select("l_returnflag", "l_linenumber").exceptAll(o.select("l_returnflag", "l_linenumber"))


@query(
    "u4_merge_split",
    "SELECT conv_id, count(*) AS n_parts, bool_or(role = 'user') AS has_user, bool_or(role = 'assistant') AS has_assistant, bool_or(role = 'user') AND bool_or(role = 'assistant') AS complete FROM conversations GROUP BY 1",
)
def u4(spark, d):
    return audit.merge_split(load(spark, d, "conversations"), "conv_id", "role", ["user", "assistant"])


@query(
    "u5_delta_plan",
    """WITH h AS (SELECT sha256(text) AS k, CAST(substr(source, 4) AS INT) % 2 AS half, count(*) AS n FROM documents GROUP BY 1, 2), c AS (SELECT * FROM h WHERE half = 0), l AS (SELECT * FROM h WHERE half = 1)
    SELECT coalesce(c.k, l.k) AS k, CASE WHEN l.k IS NULL THEN 'add' WHEN c.k IS NULL THEN 'remove_pending' WHEN c.n IS DISTINCT FROM l.n THEN 'refresh' ELSE 'keep' END AS action FROM c FULL JOIN l ON c.k = l.k""",
)
def u5(spark, d):
    """Contents of two halves of the sources, with their number of copies as the mark."""
    half = F.substring("source", 4, 9).cast("int") % 2
    h = load(spark, d, "documents").groupBy(F.sha2("text", 256).alias("k"), half.alias("half")).agg(F.count("*").alias("n"))
    return audit.delta_plan(h.filter("half = 0"), h.filter("half = 1"), "k", "n")


@query("o1_sort_largest", "SELECT doc_id, n_chars, CAST(row_number() OVER (ORDER BY n_chars DESC NULLS LAST, doc_id) AS INT) AS pos FROM documents ORDER BY n_chars DESC NULLS LAST, doc_id")
def o1(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "n_chars")
    order = [F.desc_nulls_last("n_chars"), F.col("doc_id")]
    return ranked(docs, [], order, "pos").withColumn("pos", F.col("pos").cast("int")).orderBy(*order)


@query(
    "o2_topn",
    "SELECT c_custkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY round(sum(l_extendedprice * (1 - l_discount)), 2) DESC, c_custkey LIMIT 25",
)
def o2(spark, d):
    line = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    cust = load(spark, d, "customer").select("c_custkey")
    out = line.join(load(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey").groupBy("c_custkey").agg(F.round(F.sum("r"), 2).alias("revenue"))
    return out.join(cust, "c_custkey", "left_semi").orderBy(F.desc("revenue"), "c_custkey").limit(25)
