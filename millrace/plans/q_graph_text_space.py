"""Attributes, hierarchies, texts, space and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import graph, spatial, text
from millrace.plans.registry import query
from millrace.session import load

_ATTRS = ["p_name", "p_brand", "p_type", "p_size"]


@query("e1_eav_unpivot", " UNION ALL ".join(f"SELECT p_partkey, '{a}' AS attr, CAST({a} AS VARCHAR) AS value FROM part WHERE {a} IS NOT NULL" for a in _ATTRS))
def e1(spark, d):
    return graph.unpivot(load(spark, d, "part"), "p_partkey", _ATTRS)


@query("e2_eav_pivot", "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part")
def e2(spark, d):
    return graph.pivot(graph.unpivot(load(spark, d, "part"), "p_partkey", _ATTRS), "p_partkey", _ATTRS)


@query(
    "e4_attribute_map",
    "SELECT event_id, 'kind=' || CASE event_type WHEN 'error' THEN 'Failure' ELSE event_type END || ';user=' || user_id AS attributes FROM events WHERE event_id % 7 >= 0",
)
def e4(spark, d):
    eav = graph.unpivot(load(spark, d, "events").select("event_id", "event_type", "user_id"), "event_id", ["event_type", "user_id"])
    names = spark.sql("SELECT * FROM VALUES ('event_type', 'kind'), ('user_id', 'user') t(attr, name)")
    codes = spark.sql("SELECT * FROM VALUES ('event_type', 'error', 'Failure') t(attr, value, label)")
    out = graph.attribute_map(eav, "event_id", F.broadcast(names), codelist=F.broadcast(codes))  # two rows and one
    return out.select("event_id", F.array_join(F.transform(F.map_entries("attributes"), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("attributes"))


@query(
    "e3_recursive_path",
    """WITH n AS (SELECT 'n' || n_nationkey AS c, 'r' || n_regionkey AS p FROM nation UNION ALL SELECT 'r' || r_regionkey, NULL FROM region UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier)
    SELECT a.c AS node, CASE WHEN a.p IS NULL THEN a.c WHEN b.p IS NULL THEN a.p || '/' || a.c ELSE b.p || '/' || a.p || '/' || a.c END AS path, CASE WHEN a.p IS NULL THEN 0 WHEN b.p IS NULL THEN 1 ELSE 2 END AS depth, false AS cut
    FROM n a LEFT JOIN n b ON b.c = a.p""",
)
def e3(spark, d):
    return graph.paths_to_root(_hierarchy(spark, d), "c", "p")


_NODES = "WITH RECURSIVE n AS (SELECT 'n' || n_nationkey AS c, 'r' || n_regionkey AS p FROM nation UNION ALL SELECT 'r' || r_regionkey, NULL FROM region UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier)"


@query(
    "e6_descendants",
    _NODES
    + """, w AS (SELECT c AS node, p AS up, 1 AS step FROM n WHERE p IS NOT NULL UNION ALL SELECT w.node, n.p, w.step + 1 FROM w JOIN n ON n.c = w.up WHERE n.p IS NOT NULL),
    t AS (SELECT c FROM n WHERE c NOT IN (SELECT p FROM n WHERE p IS NOT NULL)), k AS (SELECT up, count(*) AS n, count(*) FILTER (node IN (SELECT c FROM t)) AS l FROM w GROUP BY 1)
    SELECT c AS node, CAST((SELECT count(*) FROM w WHERE w.node = c) AS INT) AS depth, coalesce(k.n, 0) AS n_descendants, coalesce(k.l, 0) AS n_leaves FROM n LEFT JOIN k ON k.up = c""",
)
def e6(spark, d):
    return graph.descendants(_hierarchy(spark, d), "c", "p")


def _hierarchy(spark, d):
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nodes = load(spark, d, "nation").select(key("n", "n_nationkey").alias("c"), key("r", "n_regionkey").alias("p"))
    nodes = nodes.unionByName(load(spark, d, "region").select(key("r", "r_regionkey").alias("c"), F.lit(None).cast("string").alias("p")))
    return nodes.unionByName(load(spark, d, "supplier").select(key("s", "s_suppkey").alias("c"), key("n", "s_nationkey").alias("p")))


@query("e5_leaves", "SELECT 'n' || n_nationkey AS c FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier) UNION ALL SELECT 's' || s_suppkey FROM supplier UNION ALL SELECT 'r' || r_regionkey FROM region WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation)")
def e5(spark, d):
    return graph.leaves(_hierarchy(spark, d), "c", "p").select("c")


@query(
    "t1_doc_class",
    r"""WITH c AS (SELECT sha256(text) AS sha, CASE WHEN regexp_matches(text, '[#*$%&]{3}') THEN 'cad' WHEN length(text) >= 3000 THEN 'cad' WHEN regexp_matches(text, '[Ll]icense') THEN 'document' WHEN length(text) > 0 THEN 'document' ELSE 'unknown' END AS class FROM documents)
    SELECT class, count(*) AS n_raw, count(DISTINCT sha) AS n_unique FROM c GROUP BY 1""",
)
def t1(spark, d):
    t = F.col("text")
    kind = S.first_match([(F.rlike(t, F.lit("[#*$%&]{3}")), "cad"), (F.length(t) >= 3000, "cad"), (F.rlike(t, F.lit("[Ll]icense")), "document"), (F.length(t) > 0, "document")], "unknown")
    one = load(spark, d, "documents").groupBy(F.sha2(t, 256).alias("sha")).agg(F.count("*").alias("n"), F.first(kind).alias("class"))  # once per content
    return one.groupBy("class").agg(F.sum("n").alias("n_raw"), F.count("*").alias("n_unique"))


_P = {"EMAIL": text.EMAIL, "PHONE": text.PHONE}


@query("t2_pii_redact", f"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '{text.EMAIL}', '[EMAIL]', 'g'), '{text.PHONE}', '[PHONE]', 'g')) AS redacted FROM documents")
def t2(spark, d):
    return load(spark, d, "documents").select("doc_id", F.md5(text.mask(F.col("text"), _P)).alias("redacted"))


@query(
    "t3_regex_count",
    f"SELECT doc_id, len(regexp_extract_all(text, '{text.EMAIL}')) AS n_email, len(regexp_extract_all(text, '[0-9]+')) AS n_numbers, CAST((length(text) - length(replace(text, 'the', ''))) / 3 AS BIGINT) AS n_the FROM documents",
)
def t3(spark, d):
    t = F.col("text")
    n = lambda p: F.regexp_count(t, F.lit(p)).cast("long")
    return load(spark, d, "documents").select("doc_id", n(text.EMAIL).alias("n_email"), n("[0-9]+").alias("n_numbers"), (F.size(F.split(t, "the")) - 1).cast("long").alias("n_the"))


_TOK = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda w: w <> '')"


@query(
    "t4_collateral",
    f"""WITH a AS (SELECT doc_id, unnest({_TOK.format('text')}) AS w FROM documents), b AS (SELECT doc_id, unnest({_TOK.format(f"regexp_replace(text, '{text.EMAIL}', '[EMAIL]', 'g')")}) AS w FROM documents),
    x AS (SELECT doc_id, w, count(*) AS n FROM a GROUP BY 1, 2), y AS (SELECT doc_id, w, count(*) AS n FROM b GROUP BY 1, 2)
    SELECT x.doc_id, CAST(sum(x.n - coalesce(y.n, 0)) AS BIGINT) AS n_removed, count(*) AS n_words FROM x LEFT JOIN y ON x.doc_id = y.doc_id AND x.w = y.w WHERE x.n > coalesce(y.n, 0) GROUP BY 1""",
)
def t4(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text").filter(F.rlike("text", F.lit(text.EMAIL)))  # the others lose nothing
    return text.removed_tokens(docs, "doc_id", text.words(F.col("text")), text.words(text.mask(F.col("text"), {"EMAIL": text.EMAIL})))


@query(
    "t6_bag_overlap",
    f"""WITH b AS (SELECT item_id, unnest({_TOK.format('text')}) AS w FROM benchmark), q AS (SELECT item_id, w, count(*) AS n FROM b GROUP BY 1, 2), c AS (SELECT doc_id, unnest({_TOK.format('text')}) AS w FROM documents), p AS (SELECT doc_id, w, count(*) AS n FROM c GROUP BY 1, 2),
    s AS (SELECT item_id, doc_id, sum(least(q.n, p.n)) AS shared FROM q JOIN p USING (w) GROUP BY 1, 2), a AS (SELECT item_id, sum(n) AS n FROM q GROUP BY 1), z AS (SELECT doc_id, sum(n) AS n FROM p GROUP BY 1)
    SELECT item_id, doc_id, CAST(shared AS BIGINT) AS shared, round(shared / least(a.n, z.n), 4) AS overlap, round(shared / (a.n + z.n - shared), 4) AS jaccard FROM s JOIN a USING (item_id) JOIN z USING (doc_id) WHERE shared >= 0.5 * least(a.n, z.n)""",
)
def t6(spark, d):
    """Benchmark items of which a document holds half the words, or the reverse: all words of all documents."""
    from millrace.operators.match import bag_overlap

    bags = lambda table, i: load(spark, d, table).select(i, text.words(F.col("text")).alias("words"))
    return bag_overlap(bags("benchmark", "item_id"), bags("documents", "doc_id"), "item_id", "doc_id", "words", 0.5)


def _points(spark, d):
    e = load(spark, d, "embeddings")
    return e.select("vec_id", "label", *(F.element_at("embedding", i + 1).cast("double").alias(a) for i, a in enumerate("xyz")))


_PTS = "WITH p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings)"
_DIST = "sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z))"


@query("x1_grid_radius_join", _PTS + f"SELECT a.vec_id AS l_vec_id, b.vec_id AS r_vec_id, round({_DIST}, 6) AS dist FROM p a JOIN p b ON a.vec_id < b.vec_id AND {_DIST} <= 0.02")
def x1(spark, d):
    p = _points(spark, d)
    return spatial.radius_join(p, p, ["x", "y", "z"], 0.02).filter("l_vec_id < r_vec_id").select("l_vec_id", "r_vec_id", F.round("dist", 6).alias("dist"))


@query(
    "x2_nearest_same_key",
    _PTS + f", r AS (SELECT a.vec_id, b.vec_id AS nearest, {_DIST} AS dist, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_DIST}, b.vec_id) AS rn FROM p a JOIN p b ON a.label = b.label AND a.vec_id <> b.vec_id AND {_DIST} <= 0.05) SELECT vec_id, nearest, round(dist, 6) AS dist FROM r WHERE rn = 1",
)
def x2(spark, d):
    p = _points(spark, d)
    pairs = spatial.radius_join(p, p, ["x", "y", "z"], 0.05, ["label"]).filter("l_vec_id <> r_vec_id")
    return spatial.nearest(pairs, "l_vec_id", "r_vec_id").select(F.col("l_vec_id").alias("vec_id"), F.col("r_vec_id").alias("nearest"), F.round("dist", 6).alias("dist"))


@query("x3_range_join", "SELECT a.c_custkey AS l_custkey, b.s_suppkey AS r_suppkey, round(abs(a.c_acctbal - b.s_acctbal), 2) AS gap FROM customer a JOIN supplier b ON abs(a.c_acctbal - b.s_acctbal) <= 2 AND a.c_nationkey = b.s_nationkey")
def x3(spark, d):
    c = load(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"))
    s = load(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("bal"))
    out = spatial.range_join(c, s, "bal", 2.0, F.col("l_nation") == F.col("r_nation"))
    return out.select(F.col("l_c_custkey").alias("l_custkey"), F.col("r_s_suppkey").alias("r_suppkey"), F.round(F.abs(F.col("l_bal") - F.col("r_bal")), 2).alias("gap"))


@query(
    "x4_box_overlap",
    _PTS + ", b AS (SELECT vec_id // 10 AS k, min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM p GROUP BY 1) SELECT a.k AS l_k, b.k AS r_k FROM b a JOIN b ON a.k < b.k AND a.xl <= b.xh AND b.xl <= a.xh AND a.yl <= b.yh AND b.yl <= a.yh",
)
def x4(spark, d):
    p = _points(spark, d).withColumn("k", F.floor(F.col("vec_id") / 10))
    b = spatial.boxes(p, ["k"], ["x", "y"])
    return spatial.overlapping(b, b, ["x", "y"], 0.1, "k").filter("l_k < r_k").select("l_k", "r_k")


@query(
    "x5_group_geometry",
    _PTS
    + """SELECT label, count(*) AS n, round(sum(1 + abs(x)), 4) AS total, round(sum((1 + abs(x)) * x) / sum(1 + abs(x)), 4) AS c_x, round(sum((1 + abs(x)) * y) / sum(1 + abs(x)), 4) AS c_y,
    round(min(x), 4) AS x_lo, round(max(x), 4) AS x_hi, round(min(y), 4) AS y_lo, round(max(y), 4) AS y_hi FROM p GROUP BY 1""",
)
def x5(spark, d):
    return spatial.group_geometry(_points(spark, d).withColumn("w", 1 + F.abs(F.col("x"))), ["label"], ["x", "y"], "w")


@query(
    "x6_offset_vote",
    _PTS + ", v AS (SELECT label, CAST(floor((x - y) / 0.05 + 0.5) AS BIGINT) AS vote, count(*) AS n FROM p GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, vote) AS rn FROM v) SELECT label, vote, n AS votes FROM r WHERE rn = 1",
)
def x6(spark, d):
    return spatial.offset_vote(_points(spark, d), ["label"], F.col("x") - F.col("y"), 0.05)


@query("x7_one_to_one")
def x7(spark, d):
    p = _points(spark, d)
    out = spatial.match_points(p.filter("vec_id % 2 = 0"), p.filter("vec_id % 2 = 1"), ["x", "y", "z"], 0.05, "vec_id")
    return out.select("l_vec_id", "r_vec_id", F.round("dist", 6).alias("dist"))


@query(
    "x8_spatial_tiles",
    _PTS
    + """, c AS (SELECT *, CAST(floor(x / 0.1) AS BIGINT) AS i, CAST(floor(y / 0.1) AS BIGINT) AS j FROM p) SELECT vec_id, CAST(ntile(8) OVER (ORDER BY i, j, z, vec_id) AS INT) AS tile FROM c""",
)
def x8(spark, d):
    return spatial.tiles(_points(spark, d), ["x", "y"], "z", "vec_id", 0.1, 8).select("vec_id", "tile")


@query(
    "m2_shoelace",
    _PTS
    + """, o AS (SELECT label, x, y, lead(x) OVER w AS nx, lead(y) OVER w AS ny, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy FROM p WINDOW w AS (PARTITION BY label ORDER BY vec_id))
    SELECT label, count(*) AS n, round(abs(sum(x * coalesce(ny, fy) - coalesce(nx, fx) * y)) / 2, 4) AS area FROM o GROUP BY 1""",
)
def m2(spark, d):
    """Edges, not whole polygons: each point meets the next one, so a ring of any length is an aggregate."""
    w = Window.partitionBy("label").orderBy("vec_id")
    pts = _points(spark, d).select("label", "x", "y", F.coalesce(F.lead("x").over(w), F.first("x").over(w)).alias("nx"), F.coalesce(F.lead("y").over(w), F.first("y").over(w)).alias("ny"))
    return pts.groupBy("label").agg(F.count("*").alias("n"), F.round(F.abs(F.sum(F.col("x") * F.col("ny") - F.col("nx") * F.col("y"))) / 2, 4).alias("area"))


@query(
    "f1_keys",
    r"""SELECT p_partkey, substr(lower(regexp_replace(p_name, '[\s''"`]', '', 'g')), 1, 60) AS canon, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS key, regexp_replace(replace(regexp_replace(upper(p_type), '\s+', '', 'g'), '*', 'X'), 'X+', 'X', 'g') AS profile,
    regexp_replace(p_name, '[^A-Za-z0-9._-]+', '_', 'g') AS safe, substr(sha256(p_name), 1, 16) AS prefix, split_part(p_type, ' ', -1) AS last_token FROM part""",
)
def f1(spark, d):
    n, t = F.col("p_name"), F.col("p_type")
    return load(spark, d, "part").select("p_partkey", S.canon_name(n).alias("canon"), S.canon_key(n).alias("key"), S.profile_norm(t).alias("profile"), S.safe_component(n).alias("safe"), S.sha_prefix(n).alias("prefix"), F.element_at(F.split(t, " "), -1).alias("last_token"))


@query(
    "f2_numbers",
    """SELECT o_orderkey, CASE WHEN o_totalprice = 0 THEN 0.0 ELSE round(o_totalprice * pow(10, 2 - floor(log10(abs(o_totalprice))))) / pow(10, 2 - floor(log10(abs(o_totalprice)))) END AS sig3,
    round(degrees(atan2(o_custkey, o_orderkey + 1)), 6) AS angle, CAST(floor(epoch(o_orderdate) / 86400) AS BIGINT) AS day, CASE WHEN o_custkey % 4 <> 0 THEN floor(CAST(o_orderkey % 4 AS DOUBLE) / (o_custkey % 4) * 1e4) / 1e4 END AS ratio FROM orders""",
)
def f2(spark, d):
    o = load(spark, d, "orders")
    day = F.floor(F.col("o_orderdate").cast("timestamp").cast("double") / 86400)
    return o.select("o_orderkey", S.round_sig(F.col("o_totalprice"), 3).alias("sig3"), F.round(F.degrees(F.atan2("o_custkey", F.col("o_orderkey") + 1)), 6).alias("angle"), day.alias("day"), S.floor_ratio(F.col("o_orderkey") % 4, F.col("o_custkey") % 4).alias("ratio"))


@query(
    "f3_vectors",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)
    SELECT vec_id, round(sqrt(list_sum(list_transform(e, lambda x: x * x))), 6) AS norm, round(e[1] * e[4] + e[2] * e[5] + e[3] * e[6], 6) AS dot3, round(e[2] * e[6] - e[3] * e[5], 6) AS cross_x FROM v""",
)
def f3(spark, d):
    e = F.transform("embedding", lambda x: x.cast("double"))
    v = load(spark, d, "embeddings").select("vec_id", e.alias("e"))
    a, b = F.slice("e", 1, 3), F.slice("e", 4, 3)
    return v.select("vec_id", F.round(S.norm(F.col("e")), 6).alias("norm"), F.round(S.dot(a, b), 6).alias("dot3"), F.round(F.element_at(S.cross(a, b), 1), 6).alias("cross_x"))
