"""Deliveries: packages, findings, comparisons, resolution and plans. Frames that the tables don't have as such are made by SQL that both engines run."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from millrace.functions import names
from millrace.functions import scalars as S
from millrace.operators import adapters, audit, compare, cover, finding_rules, grade, package, resolve, spatial
from millrace.plans.q_grades import _FINDINGS, _findings
from millrace.plans.registry import query
from millrace.session import load


def made(spark, d, sql):
    """A frame by SQL with {table} for each table."""
    return spark.sql(sql, **{t: load(spark, d, t) for t in re.findall(r"\{(\w+)\}", sql)})


def duck(sql):
    return re.sub(r"\{(\w+)\}", r"\1", sql)


_BASE = """SELECT CASE WHEN CAST(substr(source, 4) AS INT) % 2 = 0 OR (source = 'src3' AND lang = 'es') THEN '3d' ELSE '2d' END AS route, source AS project, CASE WHEN n_chars > 1000 THEN 'model/step/' ELSE 'doc/text/' END || md5(text) AS relpath,
    d.doc_id, md5(text) AS etag, n_chars, md5(lower(text)) AS low, coalesce(l.toxic, 0) AS toxic, coalesce(l.quality, -1) AS quality FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id"""
_MANIFEST = f"SELECT route, project, relpath, etag, n_chars AS bytes, CASE WHEN toxic = 0 THEN 'conv' END AS step_source, CASE WHEN quality = 1 THEN 'doc/text/' || low END AS converted_from, 'k' || CAST(n_chars AS STRING) AS source_key FROM ({_BASE}) b"
_OBJECTS = f"SELECT route, project, CASE WHEN toxic = 1 THEN 'doc/x/' || CAST(doc_id AS STRING) ELSE relpath END AS relpath, n_chars + CASE WHEN quality = 0 THEN 1 ELSE 0 END AS size FROM ({_BASE}) b"
_PROJECTS = f"""SELECT route, project, count(*) AS files, CASE WHEN project = 'src4' THEN 'xx' WHEN project <> 'src10' THEN route END AS declared_route,
    CASE WHEN project <> 'src10' THEN CAST(sum(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END) + CASE WHEN project = 'src6' THEN 1 ELSE 0 END AS BIGINT) END AS model_step, project <> 'src8' AS manifest_ok, project <> 'src10' AS project_ok FROM ({_BASE}) b GROUP BY route, project
    UNION ALL SELECT '3d', 'none', 0, '3d', 0, false, true UNION ALL SELECT '2d', 'lost', 5, '2d', 0, false, true"""
_CHECKS = f"""WITH m AS ({duck(_MANIFEST)}), o AS (SELECT route, project, relpath, max(size) AS size FROM ({duck(_OBJECTS)}) GROUP BY 1, 2, 3), p AS ({duck(_PROJECTS)}),
    r AS (SELECT route, project, relpath, count(*) AS k, min(bytes) AS lo, max(bytes) AS hi FROM m GROUP BY 1, 2, 3), j AS (SELECT * FROM r FULL JOIN o USING (route, project, relpath)), s AS (SELECT *, split_part(relpath, '/', 1) || '/' || split_part(relpath, '/', 2) AS ch FROM m),
    st AS (SELECT * FROM m WHERE starts_with(relpath, 'model/step/')), c AS (SELECT route, project, count(*) AS steps FROM st GROUP BY 1, 2), pc AS (SELECT p.*, coalesce(steps, 0) AS steps FROM p LEFT JOIN c USING (route, project)),
    x AS (SELECT 'duplicate_relpath_rows' AS "check", route, project, CAST(sum(k - 1) AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS example FROM r GROUP BY 2, 3 HAVING sum(k - 1) > 0
      UNION ALL SELECT 'rows_without_object', route, project, count(*), min(relpath) FROM j WHERE size IS NULL GROUP BY 2, 3 UNION ALL SELECT 'objects_without_row', route, project, count(*), min(relpath) FROM j WHERE k IS NULL GROUP BY 2, 3
      UNION ALL SELECT 'bytes_mismatch', route, project, count(*), min(relpath) FROM j WHERE lo <> size OR hi <> size GROUP BY 2, 3
      UNION ALL SELECT 'step_row_without_source', route, project, count(*), NULL FROM st WHERE step_source IS NULL GROUP BY 2, 3
      UNION ALL SELECT 'converted_from_missing', route, project, count(*), min(converted_from) FROM st WHERE converted_from IS NOT NULL AND NOT EXISTS (SELECT 1 FROM m WHERE m.route = st.route AND m.project = st.project AND m.relpath = st.converted_from) GROUP BY 2, 3
      UNION ALL SELECT 'projects_with_content_duplicates', route, project, CAST(sum(n - 1) AS BIGINT), NULL FROM (SELECT route, project, ch, etag, bytes, count(*) AS n FROM s GROUP BY ALL) GROUP BY 2, 3 HAVING sum(n - 1) > 0
      UNION ALL SELECT 'projects_with_conversion_placed_twice', route, project, CAST(sum(n - 1) AS BIGINT), NULL FROM (SELECT route, project, source_key, count(*) AS n FROM st WHERE converted_from IS NOT NULL GROUP BY ALL) GROUP BY 2, 3 HAVING sum(n - 1) > 0
      UNION ALL SELECT 'project_json_unreadable', route, project, 1, NULL FROM pc WHERE NOT project_ok UNION ALL SELECT 'step_in_2d', route, project, steps, NULL FROM pc WHERE route = '2d' AND steps > 0 UNION ALL SELECT '3d_without_step', route, project, 1, NULL FROM pc WHERE route = '3d' AND steps = 0
      UNION ALL SELECT 'project_json_route_mismatch', route, project, 1, declared_route FROM pc WHERE declared_route IS DISTINCT FROM route
      UNION ALL SELECT 'slots_model_step_mismatch', route, project, 1, concat_ws(' ', model_step, steps) FROM pc WHERE route = '3d' AND model_step IS DISTINCT FROM steps
      UNION ALL SELECT 'project_in_both_routes', route, project, 1, NULL FROM pc WHERE route = '3d' AND project IN (SELECT project FROM p WHERE route = '2d')),
    y AS (SELECT x.* FROM x JOIN p USING (route, project) WHERE manifest_ok UNION ALL
      SELECT CASE WHEN project_ok AND files = 0 AND NOT EXISTS (SELECT 1 FROM o WHERE o.route = p.route AND o.project = p.project) THEN 'empty_packages' ELSE 'manifest_unreadable' END, route, project, 1, NULL FROM p WHERE NOT manifest_ok)"""


def _package(spark, d):
    return package.package_checks(*(made(spark, d, sql) for sql in (_MANIFEST, _OBJECTS, _PROJECTS)))


@query("v4_package_verify", _CHECKS + ' SELECT "check", route, project, n, example FROM y')
def v4(spark, d):
    return _package(spark, d)


@query("v5_package_report", _CHECKS + """, z AS (SELECT *, row_number() OVER (PARTITION BY "check" ORDER BY route, project) AS rn FROM y) SELECT "check", count(*) AS n_projects, CAST(sum(n) AS BIGINT) AS total, string_agg(route || '/' || project, ',' ORDER BY route || '/' || project) FILTER (rn <= 50) AS examples FROM z GROUP BY 1""")
def v5(spark, d):
    return package.package_report(_package(spark, d))


_LINES = """SELECT l_orderkey, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r, sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS a, sum(CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END) AS dd, sum(CASE WHEN l_tax >= 0.07 THEN 1 ELSE 0 END) AS t,
    sum(CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END) AS q, sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS f, sum(l_quantity) AS sq, max(l_quantity) AS mq, min(l_suppkey) AS s FROM {lineitem} GROUP BY l_orderkey"""
_PARTS = ", ".join(f"CASE WHEN {col} > {k} AND f {'>' if j else '<='} 2 THEN {col} ELSE 0 END AS n_{issue}_{cause}" for issue, col in (("open_shell", "r"), ("broken_solid", "dd"), ("empty_part", "t")) for j, (k, cause) in enumerate(((1, "pipeline"), (1, "unclassified"), (2, "source"))))
_MODELS = f"""SELECT o_orderkey, CASE WHEN n IS NULL THEN 'empty' WHEN mq <= 3 THEN 'compressed' WHEN n = 1 AND q = 1 THEN 'not_step' WHEN n = 1 AND a = 1 THEN 'other' ELSE 'step' END AS kind, coalesce(sq, 0) > 12 AS end_marker,
    CASE WHEN n = 2 AND r = 2 THEN 'cis2' WHEN n = 2 AND a = 2 THEN 'none' ELSE 'geometry' END AS schema_class, coalesce(f, 0) AS solid_entities, coalesce(r, 0) + coalesce(a, 0) AS surface_entities, CASE WHEN o_orderstatus <> 'P' THEN s % 11 <> 0 END AS manifest_found,
    CASE WHEN s % 13 <> 0 THEN 'x' END AS manifest_sha, 'x' AS sha, s AS manifest_bytes, CASE WHEN s % 17 = 0 THEN s + 1 ELSE s END AS bytes, s % 7 <> 0 AS is_conversion, CASE WHEN s % 5 <> 0 THEN sq / (sq + 2 * dd + a) END AS match_precision,
    CASE WHEN q > 1 THEN q ELSE 0 END AS missing_pipeline, CASE WHEN a > 1 THEN a ELSE 0 END AS missing_source, CASE WHEN t > 1 THEN t ELSE 0 END AS missing_by_design, dd AS extra_parts, n > 6 AS geometry_skipped, mq >= 50 AS geometry_error, f AS solid, CASE WHEN dd > 2 THEN 1 ELSE 0 END AS impossible_solid,
    r AS open_shell, {_PARTS}, t AS brepcheck_invalid, CASE WHEN a > 0 THEN 400 ELSE 3 END AS brepcheck_checked, CASE WHEN dd > 0 THEN 1.0 + 0.005 * dd END AS size_ratio_1, CASE WHEN t > 0 THEN 1.0 + 0.004 * t END AS size_ratio_2, 1.0 AS size_ratio_3, q AS elements_meshed, sq AS volume,
    CASE WHEN a > 0 THEN sq + a ELSE 0.0 END AS source_volume, CASE WHEN t > 2 THEN t ELSE 0 END AS impossible_elements FROM {{orders}} LEFT JOIN ({_LINES}) l ON l_orderkey = o_orderkey"""
_RULES = " UNION ALL ".join(
    f"SELECT o_orderkey, '{code}' AS code, '{level}' AS level, '{cause}' AS cause, CAST({n or 'NULL'} AS BIGINT) AS n, {i} AS place FROM m WHERE coalesce(({on}) AND ({cond}), false)"
    for i, (on, (code, level, cause, cond, n)) in enumerate((on, r) for on, rules in finding_rules.stages() for r in rules)
)


@query("g15_model_findings", f"WITH m AS ({duck(_MODELS)}), f AS ({_RULES}) SELECT o_orderkey, code, level, cause, n, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY CASE level WHEN 'FAIL' THEN 0 WHEN 'WARN' THEN 1 ELSE 2 END, place) AS INT) AS pos FROM f")
def g15(spark, d):
    return finding_rules.model_findings(made(spark, d, _MODELS), ["o_orderkey"])


_TYPES = ("PIPE", "ELBOW", "VALVE", "TEE", "FLANGE", "WELD", "BEND", "PIPE-FIXED", "OLET", "GASKET")


def _records(spark, d, right):
    e = lambda i: F.element_at("embedding", i).cast("double") * 100
    v = lambda i: F.round(e(i)) if right else e(i)
    label = F.col("label")
    bore = label.cast("double") + (F.when(label == 4, 1.0).otherwise(0.0) if right else F.lit(0.0))
    point = lambda i: F.struct(v(i).alias("x"), v(i + 1).alias("y"), v(i + 2).alias("z"), bore.alias("bore"))
    kind = F.element_at(F.array(*map(F.lit, _TYPES)), (F.when(label == 6, 1).otherwise(label) if right else label) + 1)
    key = F.concat(F.lit("K"), label.cast("string"), F.when(label % 3 == 0, F.lit("AA" if right else "**")).otherwise(F.lit("B")), F.when((label == 2) & F.lit(right), "x").otherwise(""))
    uci = F.concat(F.when((label == 8) & F.lit(right), "v").otherwise("u"), F.col("vec_id").cast("string"))
    rows = load(spark, d, "embeddings").filter(label != (9 if right else 7))
    return rows.select(uci.alias("uci"), F.lit(1).alias("ord"), kind.alias("type"), key.alias("skey"), F.array(point(4), point(1)) if right else F.array(point(1), point(4)), F.array(point(7)).alias("branches")).toDF("uci", "ord", "type", "skey", "points", "branches")


def _d(a, b):
    return f"sqrt((l{a} - r{b}) * (l{a} - r{b}) + (l{a + 1} - r{b + 1}) * (l{a + 1} - r{b + 1}) + (l{a + 2} - r{b + 2}) * (l{a + 2} - r{b + 2}))"


_COORDS = ", ".join(f"CAST(embedding[{i}] AS DOUBLE) * 100 AS l{i}, round(CAST(embedding[{i}] AS DOUBLE) * 100) AS r{i}" for i in range(1, 10))
_BACK = f"greatest(least({_d(1, 1)}, {_d(4, 1)}), least({_d(1, 4)}, {_d(4, 4)}))"
_FORTH = f"greatest(least({_d(1, 1)}, {_d(1, 4)}), least({_d(4, 1)}, {_d(4, 4)}))"
_COMPARED = f"""WITH t AS (SELECT vec_id, label, {_COORDS} FROM embeddings), k AS (SELECT *, ['PIPE', 'ELBOW', 'VALVE', 'TEE', 'FLANGE', 'WELD', 'ELBOW', 'PIPE', 'OLET', 'GASKET'][label + 1] AS kind, label IN (5, 9) AS item, label IN (0, 1, 2, 3, 4, 6) AS judged FROM t),
    c AS (SELECT 'u' || vec_id AS part, CASE WHEN label IN (8, 9) THEN 'only_left' WHEN label = 7 THEN 'only_right' ELSE 'both' END AS status, item, kind, CASE WHEN judged THEN true END AS same_kind,
      CASE WHEN judged THEN CASE WHEN label % 3 = 0 THEN 'wildcard' WHEN label = 2 THEN 'base' ELSE 'exact' END END AS key_state, CASE WHEN judged THEN round(CASE WHEN kind = 'PIPE' THEN {_BACK} ELSE greatest({_BACK}, {_FORTH}) END, 6) END AS max_dev, CASE WHEN judged THEN label <> 4 END AS bore_ok,
      CASE WHEN judged AND kind IN ('TEE', 'OLET', 'TEE-STUB') THEN {_d(7, 7)} <= 1 END AS branch_ok FROM k
      UNION ALL SELECT 'v' || vec_id, 'only_right', false, 'OLET', NULL, NULL, NULL, NULL, NULL FROM k WHERE label = 8)"""


def _compared(spark, d):
    return compare.compare_parts(_records(spark, d, False), _records(spark, d, True)).withColumn("max_dev", F.round("max_dev", 6))


@query("g16_compare_parts", _COMPARED + " SELECT * FROM c")
def g16(spark, d):
    return _compared(spark, d)


@query(
    "g17_part_counters",
    _COMPARED
    + """ SELECT kind, item, count(*) FILTER (status = 'both') AS matched, count(*) FILTER (status = 'only_left') AS only_left, count(*) FILTER (status = 'only_right') AS only_right, count(*) FILTER (same_kind) AS type_ok, count(*) FILTER (NOT same_kind) AS type_diff, count(key_state) AS key_compared,
    count(*) FILTER (key_state IN ('exact', 'wildcard')) AS key_ok, count(max_dev) AS points_compared, count(*) FILTER (max_dev <= 1) AS points_ok, count(*) FILTER (max_dev <= 5) AS within_5, count(*) FILTER (max_dev <= 25) AS within_25, count(*) FILTER (max_dev > 10) AS beyond_10, count(*) FILTER (bore_ok) AS bore_ok,
    count(branch_ok) AS branch_compared, count(*) FILTER (branch_ok) AS branch_ok FROM c GROUP BY 1, 2""",
)
def g17(spark, d):
    return compare.part_counters(_compared(spark, d))


_ISSUE_RULES = [("error", "solid healing", "converter", "invalid"), ("view", "closed geometry in the source", "source", "surfaces")]
_ISSUE_FAMILIES = [("c", "exact rebuild", "converter", "rebuild")]
_DEFAULT = ("look closer", "open", "other")


@query(
    "g18_fix_plan",
    """WITH i AS (SELECT event_type, CASE event_type WHEN 'error' THEN 'solid healing' WHEN 'view' THEN 'closed geometry in the source' WHEN 'click' THEN 'exact rebuild' ELSE 'look closer' END AS needed, CASE event_type WHEN 'error' THEN 'converter' WHEN 'view' THEN 'source' WHEN 'click' THEN 'converter' ELSE 'open' END AS category,
      'u' || user_id % 3 || ' ' || CASE event_type WHEN 'error' THEN 'invalid' WHEN 'view' THEN 'surfaces' WHEN 'click' THEN 'rebuild' ELSE 'other' END AS grp, user_id, event_id % 4 AS n FROM events)
    SELECT needed, category, grp, count(DISTINCT user_id) AS n_models, CAST(sum(n) AS BIGINT) AS n FROM i GROUP BY 1, 2, 3""",
)
def g18(spark, d):
    ev = load(spark, d, "events").select(F.col("user_id").alias("model"), F.col("event_type").alias("type"), (F.col("event_id") % 4).alias("n"), F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")).alias("pipe"))
    return grade.fix_plan(ev, _ISSUE_RULES, _ISSUE_FAMILIES, "pipe", _DEFAULT)


@query(
    "g19_class1_gate",
    _FINDINGS
    + """, v AS (SELECT o_orderkey AS l_orderkey, CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'WARN' ELSE 'FAIL' END AS verdict, CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS tier FROM orders)
    SELECT l_orderkey, verdict, tier, verdict IN ('PASS', 'WARN') AND tier = 'A' AND NOT EXISTS (SELECT 1 FROM f WHERE f.l_orderkey = v.l_orderkey AND (level = 'FAIL' OR (level = 'WARN' AND cause NOT IN ('SOURCE', 'BY_DESIGN')))) AS class1_ok FROM v""",
)
def g19(spark, d):
    o = load(spark, d, "orders")
    verdict = S.first_match([(F.col("o_orderstatus") == "F", "PASS"), (F.col("o_orderstatus") == "O", "WARN")], "FAIL")
    v = o.select(F.col("o_orderkey").alias("l_orderkey"), verdict.alias("verdict"), F.when(F.col("o_custkey") % 2 == 0, "A").otherwise("B").alias("tier"))
    return grade.class1_gate(_findings(spark, d), v, ["l_orderkey"])


_KEYED = """SELECT sha, size, CASE WHEN s < 5 THEN 'root/a/' || CAST(doc AS STRING) WHEN s < 9 THEN 'src:p/' || CAST(doc AS STRING) WHEN s < 13 THEN 'sha256:' || sha WHEN s < 17 THEN 'other/' || CAST(doc AS STRING) ELSE '' END AS k
    FROM (SELECT md5(text) AS sha, n_chars AS size, doc_id AS doc, CAST(substr(source, 4) AS INT) AS s FROM {documents}) t"""


@query(
    "j18_resolve_keys",
    f"""WITH k AS ({duck(_KEYED)}), c AS (SELECT sha, max(size) AS size, min(k) FILTER (starts_with(k, 'root/')) AS r, min(substr(k, 5)) FILTER (starts_with(k, 'src:')) AS s, bool_or(starts_with(k, 'sha256:')) AS m FROM k GROUP BY 1),
    mk AS (SELECT md5(text) AS sha, min('m' || d.doc_id) AS p FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 1 GROUP BY 1), o1 AS (SELECT md5(text) AS sha, length(text) - CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS size, min('d' || d.doc_id) AS p FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2),
    o2 AS (SELECT md5(text) AS sha, min('e' || doc_id) AS p FROM documents WHERE lang = 'en' GROUP BY 1)
    SELECT c.sha, c.size, coalesce(r, s, CASE WHEN m THEN mk.p END, o1.p, o2.p) AS place, CASE WHEN r IS NOT NULL THEN 'disk_real' WHEN s IS NOT NULL THEN 'disk_source' WHEN m AND mk.p IS NOT NULL THEN 'disk_marker' WHEN o1.p IS NOT NULL THEN 'map' WHEN o2.p IS NOT NULL THEN 'format_list' ELSE 'unresolved' END AS how
    FROM c LEFT JOIN mk ON mk.sha = c.sha LEFT JOIN o1 ON o1.sha = c.sha AND o1.size = c.size LEFT JOIN o2 ON o2.sha = c.sha""",
)
def j18(spark, d):
    contents = made(spark, d, _KEYED).groupBy("sha").agg(F.max("size").alias("size"), F.collect_set("k").alias("keys"))
    docs = load(spark, d, "documents").select("doc_id", "lang", "text", F.md5("text").alias("sha"))
    place = lambda p: F.concat(F.lit(p), F.col("doc_id").cast("string")).alias("place")
    labelled = docs.join(load(spark, d, "labels"), "doc_id")
    sized = labelled.select("sha", (F.length("text") - F.when(F.col("toxic") == 1, 1).otherwise(0)).cast("long").alias("size"), place("d"))
    others = [("map", sized, True), ("format_list", docs.filter("lang = 'en'").select("sha", place("e")), False)]
    out = resolve.resolve_keys(contents, "sha", "keys", "size", "root", labelled.filter("quality = 1").select("sha", place("m")), others)
    return out.select("sha", "size", "place", "how")


@query(
    "v6_residual",
    """WITH p AS (SELECT source, lang, count(*) AS n_rows, CASE WHEN lang <> 'es' THEN source END AS src FROM documents GROUP BY 1, 2), m AS (SELECT DISTINCT source AS src, CAST(substr(source, 4) AS BIGINT) AS size FROM documents WHERE CAST(substr(source, 4) AS INT) % 5 <> 0), t AS (SELECT 'r' || src AS rel, size + CASE WHEN size % 4 = 0 THEN 1 ELSE 0 END AS size FROM m WHERE size % 3 <> 0)
    SELECT p.source, lang, n_rows, CASE WHEN p.src IS NULL THEN 'unknown_source' WHEN m.src IS NULL THEN 'source_not_mapped' WHEN t.rel IS NULL THEN 'not_on_later_disk' WHEN t.size <> m.size THEN 'later_copy_differs_size' ELSE 'same_size_on_later_disk' END AS reason FROM p LEFT JOIN m ON m.src = p.src LEFT JOIN t ON t.rel = 'r' || m.src""",
)
def v6(spark, d):
    docs = load(spark, d, "documents")
    packs = docs.groupBy("source", "lang").agg(F.count("*").alias("n_rows")).withColumn("src", F.when(F.col("lang") != "es", F.col("source")))
    size = F.substring("source", 4, 9).cast("long")
    mapped = docs.select(F.col("source").alias("src"), size.alias("size")).distinct().filter("size % 5 <> 0").withColumn("rel", F.concat(F.lit("r"), "src"))
    later = mapped.filter("size % 3 <> 0").select("rel", (F.col("size") + F.when(F.col("size") % 4 == 0, 1).otherwise(0)).alias("size"))
    return audit.residual(packs, mapped, later, "src").select("source", "lang", "n_rows", "reason")


@query(
    "u6_refresh_plan",
    """WITH s AS (SELECT o_custkey AS k, max(o_orderdate) AS modified, count(*) AS size FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1), c AS (SELECT c_mktsegment AS project, c_custkey AS k, max(o_orderdate) AS modified, count(*) AS size FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT project, c.k, CASE WHEN s.k IS NULL THEN 'missing' WHEN s.modified > c.modified OR s.size <> c.size THEN 'stale' ELSE 'fresh' END AS state FROM c LEFT JOIN s ON s.k = c.k""",
)
def u6(spark, d):
    orders = load(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderdate", "o_orderstatus")
    one = lambda df, *by: df.groupBy(*by).agg(F.max("o_orderdate").alias("modified"), F.count("*").alias("size"))
    copies = orders.join(load(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("project")), "k")
    return audit.refresh_plan(one(orders.filter("o_orderstatus <> 'P'"), "k"), one(copies, "project", "k"), "k", "project")


@query("w13_set_cover")
def w13(spark, d):
    """Sources whose words cover the benchmark's; tested against a plain loop."""
    words = lambda t, *keep: load(spark, d, t).select(*keep, F.explode(F.split("text", "[^A-Za-z]+")).alias("w")).filter("w <> ''")
    return cover.greedy_cover(words("benchmark"), words("documents", "source"), "w", "source", 0.001)


_POINTS = "SELECT vec_id AS id, CAST(embedding[0] AS DOUBLE) AS x, CAST(embedding[1] AS DOUBLE) AS y, CAST(embedding[2] AS DOUBLE) AS z, CAST(label AS DOUBLE) AS v FROM {embeddings}"


@query("x9_match_passes")
def x9(spark, d):
    """Even and odd points, exact pairs before near ones; tested against a plain loop."""
    p = made(spark, d, _POINTS)
    out = spatial.match_passes(p.filter("id % 2 = 0"), p.filter("id % 2 = 1"), ["x", "y", "z"], "id", "v", 0.03, 0.05, 0.05)
    return out.withColumn("dist", F.round("dist", 6))


@query(
    "x10_tolerance_join",
    "SELECT a.c_custkey AS l_id, b.s_suppkey AS r_id FROM customer a JOIN supplier b ON abs(a.c_acctbal - b.s_acctbal) <= greatest(10, 0.01 * abs(b.s_acctbal)) AND abs(a.c_nationkey - b.s_nationkey) <= 1",
)
def x10(spark, d):
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_nationkey").cast("double").alias("nation"))
    s = load(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"), F.col("s_nationkey").cast("double").alias("nation"))
    return spatial.tolerance_join(c, s, {"bal": (10.0, 0.01), "nation": (1.0, 0.0)}).select("l_id", "r_id")


_TAGGED = """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN p_type || ' ' || replace(p_brand, '#', '') || ' #' || CAST(p_partkey AS STRING) WHEN 1 THEN p_type || ' X' || CAST(p_size AS STRING) || ' #' || CAST(p_partkey AS STRING) || ' (joist_envelope, approx it)'
    WHEN 2 THEN p_type || ' #' || CAST(p_partkey AS STRING) || ' / PL 3/8 (piece ' || CAST(p_size AS STRING) || ', inst 4, approx, member envelope)' WHEN 3 THEN '#' || CAST(p_partkey AS STRING) || ' / RB5/8 (member envelope)' WHEN 4 THEN 'BOLT ' || CAST(p_size AS STRING) || '.5 x 2.0 (grip 1.0) (inst 2)' ELSE p_name END AS name FROM {part}"""
_TAGS = "list_filter(list_transform(string_split(replace({}, 'member envelope', 'member_envelope'), ','), lambda t: split_part(trim(t), ' ', 1)), lambda t: t <> '')"


@query(
    "f4_part_names",
    f"""WITH n AS ({duck(_TAGGED)}), k AS (SELECT *, CASE WHEN regexp_matches(name, '{names.BOLT}') THEN 'bolt' WHEN regexp_matches(name, '{names.ENVELOPE}') THEN 'envelope' WHEN regexp_matches(name, '{names.PIECE}') THEN 'piece' WHEN regexp_matches(name, '{names.MEMBER}') THEN 'member' ELSE 'unknown' END AS s FROM n)
    SELECT p_partkey, CASE s WHEN 'envelope' THEN 'piece' ELSE s END AS stage, CASE s WHEN 'bolt' THEN 'BOLT' WHEN 'envelope' THEN regexp_extract(name, '{names.ENVELOPE}', 1) WHEN 'piece' THEN regexp_extract(name, '{names.PIECE}', 1) WHEN 'member' THEN regexp_extract(name, '{names.MEMBER}', 1) ELSE '' END AS member_type,
    CASE WHEN s IN ('envelope', 'piece', 'member') THEN p_partkey END AS member_id, CASE s WHEN 'envelope' THEN 0 WHEN 'piece' THEN CAST(regexp_extract(name, '{names.PIECE}', 4) AS BIGINT) END AS piece_id,
    CASE s WHEN 'bolt' THEN 'BOLT ' || regexp_extract(name, '{names.BOLT}', 2) WHEN 'envelope' THEN 'RB5/8' WHEN 'piece' THEN 'PL 3/8' WHEN 'member' THEN regexp_extract(name, '{names.MEMBER}', 2) ELSE '' END AS section, CASE WHEN s = 'piece' THEN 4 END AS inst,
    array_to_string(CASE s WHEN 'envelope' THEN ['member_envelope'] WHEN 'piece' THEN {_TAGS.format(f"regexp_extract(name, '{names.PIECE}', 6)")} WHEN 'member' THEN {_TAGS.format(f"regexp_extract(name, '{names.MEMBER}', 4)")} ELSE [] END, ',') AS tags FROM k""",
)
def f4(spark, d):
    n = made(spark, d, _TAGGED).select("p_partkey", names.parse_name(F.col("name")).alias("n"))
    return n.select("p_partkey", "n.stage", "n.member_type", "n.member_id", "n.piece_id", "n.section", "n.inst", F.array_join("n.tags", ",").alias("tags"))


_SECTIONS = "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'L' WHEN 1 THEN 'hss' WHEN 2 THEN 'TS ' ELSE 'W' END || CAST(p_size AS STRING) || CASE WHEN p_partkey % 2 = 0 THEN ' 1/2' ELSE '.50' END || 'x' || CAST(p_partkey % 9 + 1 AS STRING) || '/8' || CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN 'X.250' ELSE 'xa' END AS s FROM {part}"
_TRIM = "regexp_replace(regexp_replace(printf('%.4f', {}), '0+$', ''), '\\.$', '')"


@query(
    "f5_sections",
    f"""WITH s AS (SELECT t.*, p_size FROM ({duck(_SECTIONS)}) t JOIN part USING (p_partkey)), v AS (SELECT *, CASE p_size % 4 WHEN 0 THEN 'L' WHEN 1 THEN 'HSS' WHEN 2 THEN 'TS' ELSE 'W' END AS fam, p_size + 0.5 AS a, (p_partkey % 9 + 1) / 8.0 AS b FROM s)
    SELECT p_partkey, CASE p_partkey % 3 WHEN 2 THEN replace(upper(s), ' ', '') WHEN 0 THEN CASE WHEN fam IN ('HSS', 'TS') THEN 'ROUND' ELSE fam END || {_TRIM.format('a')} || 'X' || {_TRIM.format('b')}
      ELSE CASE fam WHEN 'TS' THEN 'HSS' ELSE fam END || {_TRIM.format('a')} || 'X' || {_TRIM.format('b')} || 'X0.25' END AS section,
    CASE WHEN p_size IN (1, 2, 3, 4, 5, 6, 8, 10, 12, 14, 16, 18, 20, 22, 24, 26, 28, 30, 32, 34, 36, 38, 40, 42, 44, 46, 48, 52, 54, 56, 60) THEN CAST(CASE p_size WHEN 3 THEN 80 WHEN 5 THEN 125 ELSE p_size * 25 END AS DOUBLE) ELSE CAST(p_size * 25 AS DOUBLE) END AS bore FROM v""",
)
def f5(spark, d):
    s = made(spark, d, _SECTIONS).join(load(spark, d, "part").select("p_partkey", "p_size"), "p_partkey")
    return s.select("p_partkey", S.section_canon(F.col("s")).alias("section"), S.bore_mm(F.col("p_size").cast("string"), F.lit("in")).alias("bore"))


_AREAS = {
    "Rectangle": "x * y", "RectangleHollow": "x * y - (x - 2 * w) * (y - 2 * w) - (4 - pi()) * (4 - 1)", "Circle": "pi() * x * x", "CircleHollow": "pi() * (x * x - (x - w) * (x - w))", "I": "2 * x * w + (y - 2 * w) * w + (4 - pi()) * 4", "L": "w * (y + x - w) + (1 - pi() / 4) * 4",
    "U": "2 * x * w + (y - 2 * w) * w", "T": "x * w + (y - w) * w + (2 - pi() / 2) * CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 4 END", "C": "w * (y + 2 * x + 2 * 3 - 4 * w)", "Z": "2 * x * w + (y - 2 * w) * w",
}


@query(
    "f6_profile_areas",
    f"WITH t AS (SELECT p_partkey, p_size % 11 AS k, p_size + 10.0 AS x, p_retailprice / 10 AS y, 2.5 AS w FROM part) SELECT p_partkey, round(CASE {' '.join(f'WHEN k = {i} THEN {a}' for i, a in enumerate(_AREAS.values()))} END, 6) AS area FROM t",
)
def f6(spark, d):
    kind = F.element_at(F.array(*map(F.lit, [*_AREAS, "Other"])), F.col("p_size") % 11 + 1)
    x, y, w, k = F.col("p_size") + 10.0, F.col("p_retailprice") / 10, F.lit(2.5), F.lit
    dims = {"x": x, "y": y, "r": x, "w": w, "b": x, "h": y, "tw": w, "tf": w, "fillet": k(2.0), "outer": k(2.0), "inner": k(1.0), "girth": k(3.0), "flange_slope": F.when(F.col("p_partkey") % 2 == 0, 0.1).otherwise(0.0)}
    return load(spark, d, "part").select("p_partkey", F.round(S.profile_area(kind, dims), 6).alias("area"))


_CATEGORY_SQL = " ".join(f"WHEN ext = '{e}' THEN '{c}'" for e, c in ({e: c for c, es in S.CATEGORY_EXTENSIONS.items() for e in es.split()} | S.FAMILIES).items())


@query(
    "p5_file_categories",
    f"""WITH e AS (SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'a.stp' WHEN 1 THEN 'b.TSC' WHEN 2 THEN 'c.j12' || page_id % 10 WHEN 3 THEN 'd.pdf' WHEN 4 THEN 'e.p_x' WHEN 5 THEN 'noext' ELSE 'f.docx' END AS path FROM pages),
    n AS (SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'stp' WHEN 1 THEN 'tsc' WHEN 2 THEN 'j###' WHEN 3 THEN 'pdf' WHEN 4 THEN 'p_*' WHEN 5 THEN '(none)' ELSE 'docx' END AS ext FROM e) SELECT page_id, ext, CASE {_CATEGORY_SQL} ELSE 'Other' END AS category FROM n""",
)
def p5(spark, d):
    path = F.element_at(F.array(*map(F.lit, ("a.stp", "b.TSC", "c.j12", "d.pdf", "e.p_x", "noext", "f.docx"))), (F.col("page_id") % 7 + 1).cast("int"))
    path = F.when(F.col("page_id") % 7 == 2, F.concat(path, (F.col("page_id") % 10).cast("string"))).otherwise(path)
    ext = S.ext_norm(path)
    return load(spark, d, "pages").select("page_id", ext.alias("ext"), S.category_of(ext).alias("category"))


def _judge(job):
    if job["toxic"] == 1 and job["quality"] == 0:
        raise ValueError("unreadable")
    return {"verdict": "FAIL" if job["toxic"] == 1 else "PASS" if job["quality"] == 1 else "odd", "findings": [{"code": "toxic", "level": "FAIL", "count": 1}] if job["toxic"] == 1 else []}


@query(
    "a19_verifier_adapter",
    "SELECT doc_id, 'labels' AS verifier, CASE WHEN toxic = 1 AND quality = 1 THEN 'FAIL' WHEN toxic = 0 AND quality = 1 THEN 'PASS' ELSE 'ERROR' END AS verdict, CASE WHEN quality = 0 THEN 'verifier_no_verdict' WHEN toxic = 1 THEN 'toxic' END AS code FROM labels",
)
def a19(spark, d):
    out = adapters.verify(load(spark, d, "labels"), _judge, "doc_id", "labels")
    return out.select("doc_id", "verifier", "verdict", F.get("findings", F.lit(0))["code"].alias("code"))
