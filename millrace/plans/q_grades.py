"""Selection, sampling, grading and verdicts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import grade, match, resolve, sample
from millrace.operators.order import ranked, slices
from millrace.plans.q_joins import _PAIRS, _is_f, sorted_price_pairs
from millrace.plans.registry import query
from millrace.session import load
from millrace.sources import io


@query(
    "w1_best_of",
    """WITH r AS (SELECT *, row_number() OVER w AS rn, first_value(o_orderkey) OVER w AS top FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderdate DESC, o_orderkey))
    SELECT o_orderkey, o_custkey, rn = 1 AS best, CASE WHEN rn > 1 THEN top END AS superseded_by FROM r""",
)
def w1(spark, d):
    rank = S.first_match([(F.col("o_orderstatus") == "F", 0), (F.col("o_orderstatus") == "O", 1)], 2)
    out = resolve.best_of(load(spark, d, "orders"), ["o_custkey"], [rank, F.desc("o_totalprice"), F.desc("o_orderdate"), F.col("o_orderkey")], "o_orderkey")
    return out.select("o_orderkey", "o_custkey", "best", "superseded_by")


@query("w2_upsert_latest", "SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def w2(spark, d):
    ev = load(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    return io.upsert(ev.filter("event_id % 2 = 0"), ev.filter("event_id % 2 = 1"), ["user_id"], ["ts", "event_id"])


@query(
    "w3_topk_per_group",
    "SELECT c_mktsegment, rn, o_orderkey, o_totalprice FROM (SELECT c_mktsegment, o_orderkey, o_totalprice, CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS rn FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rn <= 3",
)
def w3(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("c_custkey")).join(load(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    rn = F.row_number().over(Window.partitionBy("c_mktsegment").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return orders.withColumn("rn", rn).filter("rn <= 3").select("c_mktsegment", "rn", "o_orderkey", "o_totalprice")


@query(
    "w4_sticky_primary",
    """WITH p AS (SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
    r AS (SELECT o.o_custkey, o.o_orderkey, p.o_orderkey IS NOT NULL AS kept, row_number() OVER (PARTITION BY o.o_custkey ORDER BY CASE WHEN p.o_orderkey IS NOT NULL THEN 0 ELSE 1 END, o.o_totalprice DESC, o.o_orderkey) AS rn FROM orders o LEFT JOIN p USING (o_custkey, o_orderkey))
    SELECT o_custkey, o_orderkey, kept FROM r WHERE rn = 1""",
)
def w4(spark, d):
    orders = load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    before = orders.filter("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"))
    return sample.sticky(orders, before, "o_custkey", "o_orderkey", [F.desc("o_totalprice"), F.col("o_orderkey")])


@query(
    "w5_round_robin_sample",
    """WITH t AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('rr|' || doc_id), doc_id) AS turn, count(*) OVER (PARTITION BY lang) AS size FROM documents)
    SELECT doc_id, lang, CAST(turn AS INT) AS turn FROM t ORDER BY turn, size, lang LIMIT 50""",
)
def w5(spark, d):
    return sample.round_robin(load(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 50, "rr").select("doc_id", "lang", "turn")


@query(
    "w7_quota_sample",
    """WITH t AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('q|' || doc_id), doc_id) AS rn, count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM documents)
    SELECT doc_id, source FROM t WHERE rn <= greatest(1, floor(100 * n / total))""",
)
def w7(spark, d):
    return sample.quota_sample(load(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 100, "q").select("doc_id", "source")


@query("w8_hash_sample", "SELECT doc_id, source, rn FROM (SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY sha256('res|' || doc_id), doc_id) AS INT) AS rn FROM documents) WHERE rn <= 5")
def w8(spark, d):
    return sample.hash_sample(load(spark, d, "documents").select("doc_id", "source"), ["source"], "doc_id", 5, "res").select("doc_id", "source", "rn")


@query(
    "w6_record_blocks",
    """WITH b AS (SELECT conv_id, turn, role, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS block FROM conversations)
    SELECT conv_id, block, count(*) AS n_turns, min(turn) AS first_turn, string_agg(role, ',' ORDER BY turn) AS roles FROM b GROUP BY 1, 2""",
)
def w6(spark, d):
    b = sample.blocks(load(spark, d, "conversations").select("conv_id", "turn", "role"), ["conv_id"], ["turn"], F.col("role") == "user")
    return b.groupBy("conv_id", "block").agg(F.count("*").alias("n_turns"), F.min("turn").alias("first_turn"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), ",").alias("roles"))


@query(
    "w9_islands",
    """WITH n AS (SELECT user_id, ts, event_id, CASE WHEN epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 7200 THEN 1 ELSE 0 END AS new FROM events),
    i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM n) SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(ts) AS start, max(ts) AS stop FROM i GROUP BY 1, 2""",
)
def w9(spark, d):
    ev = load(spark, d, "events").select("user_id", "ts", "event_id").withColumn("s", F.col("ts").cast("timestamp").cast("double"))
    i = sample.islands(ev, ["user_id"], F.col("s"), ["ts", "event_id"], 7200)
    return i.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("ts").alias("start"), F.max("ts").alias("stop"))


@query(
    "w10_chunking",
    """WITH RECURSIVE n AS (SELECT source, n_chars AS w, CAST(greatest(1, ceil(n_chars / 10000)) AS BIGINT) AS parts, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
    c AS (SELECT DISTINCT source, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS chunk, CAST(0 AS BIGINT) AS parts, CAST(0 AS BIGINT) AS w, CAST(0 AS BIGINT) AS next, CAST(0 AS BIGINT) AS held FROM documents
      UNION ALL SELECT source, rn, chunk, parts, w, CASE WHEN parts > 1 THEN chunk + parts ELSE chunk END, CASE WHEN parts > 1 THEN 0 WHEN held > 0 AND held + w > 10000 THEN w ELSE held + w END
      FROM (SELECT n.source, n.rn, n.parts, n.w, c.held, CASE WHEN n.parts > 1 THEN c.next + CASE WHEN c.held > 0 THEN 1 ELSE 0 END WHEN c.held > 0 AND c.held + n.w > 10000 THEN c.next + 1 ELSE c.next END AS chunk FROM c JOIN n ON n.source = c.source AND n.rn = c.rn + 1))
    SELECT source, chunk, count(*) AS n, CAST(sum(w) AS BIGINT) AS size, max(parts) AS parts FROM c WHERE rn > 0 GROUP BY 1, 2""",
)
def w10(spark, d):
    docs = load(spark, d, "documents").select("source", "doc_id", "n_chars")
    out = sample.bounded_chunks(docs, ["source"], ["doc_id"], "n_chars", 10_000)
    return out.groupBy("source", "chunk").agg(F.count("*").alias("n"), F.sum("n_chars").alias("size"), F.max("parts").alias("parts"))


@query("w11_ntile_chunks", "SELECT p_partkey, p_brand, CAST(ntile(7) OVER (PARTITION BY p_brand ORDER BY p_size, p_retailprice, p_partkey) AS INT) AS tile FROM part")
def w11(spark, d):
    part = load(spark, d, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    return slices(part, ["p_brand"], [F.col("p_size"), F.col("p_retailprice"), F.col("p_partkey")], 7).select("p_partkey", "p_brand", "tile")


@query("w12_page_bounds", "SELECT o_orderstatus, o_orderkey, CAST(rn / 500 AS BIGINT) AS page FROM (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS rn FROM orders) WHERE rn % 500 = 0")
def w12(spark, d):
    rows = ranked(load(spark, d, "orders").select("o_orderstatus", "o_orderkey"), ["o_orderstatus"], [F.col("o_orderkey")], "at").withColumn("rn", F.col("at") - 1)
    return rows.filter("rn % 500 = 0").select("o_orderstatus", "o_orderkey", F.floor(F.col("rn") / 500).alias("page"))


@query(
    "g1_coverage",
    """WITH k AS (SELECT l_partkey, l_returnflag, count(*) FILTER (l_linestatus = 'F') AS e, count(*) FILTER (l_linestatus = 'O') AS f FROM lineitem GROUP BY 1, 2)
    SELECT l_returnflag, CAST(sum(e) AS BIGINT) AS expected, CAST(sum(least(e, f)) AS BIGINT) AS matched, floor(sum(least(e, f)) / sum(e) * 1e4) / 1e4 AS coverage FROM k GROUP BY 1""",
)
def g1(spark, d):
    line = load(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus")
    counts = match.counts_within(line, ["l_partkey", "l_returnflag"], _is_f())
    return match.coverage(counts, ["l_returnflag"])


@query(
    "g2_volume_band",
    _PAIRS
    + """, b AS (SELECT CASE WHEN f_price IS NULL OR o_price IS NULL OR o_price = 0 OR f_price <= 0 THEN 'unchecked' WHEN f_price < 1000 THEN 'sliver' WHEN abs(o_price / f_price - 1) <= 0.05 THEN 'within' WHEN p_type NOT LIKE 'PROMO%' THEN 'outside'
      WHEN o_price / f_price BETWEEN 0.9 AND 1.05 THEN 'curved' ELSE 'curved_gross' END AS band FROM p JOIN part ON l_partkey = p_partkey) SELECT band, count(*) AS n FROM b GROUP BY 1""",
)
def g2(spark, d):
    pairs = sorted_price_pairs(spark, d).join(load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    band = grade.band(F.col("o_price"), F.col("f_price"), F.startswith("p_type", F.lit("PROMO")))
    return pairs.groupBy(band.alias("band")).agg(F.count("*").alias("n"))


@query(
    "g3_adaptive_mode",
    """WITH f AS (SELECT p_brand, l_partkey, l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'F'), o AS (SELECT p_brand, l_partkey, l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'O'),
    ids AS (SELECT coalesce(a.p_brand, b.p_brand) AS p_brand, count(*) FILTER (a.l_orderkey IS NOT NULL AND b.l_orderkey IS NOT NULL) AS hits, count(a.l_orderkey) AS nl, count(b.l_orderkey) AS nr FROM (SELECT DISTINCT p_brand, l_orderkey FROM f) a FULL JOIN (SELECT DISTINCT p_brand, l_orderkey FROM o) b ON a.p_brand = b.p_brand AND a.l_orderkey = b.l_orderkey GROUP BY 1),
    nm AS (SELECT p_brand, CAST(sum(least(e, g)) AS BIGINT) AS m, CAST(sum(e) AS BIGINT) AS e, CAST(sum(g) AS BIGINT) AS g FROM (SELECT p_brand, l_partkey, count(*) FILTER (l_linestatus = 'F') AS e, count(*) FILTER (l_linestatus = 'O') AS g FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) GROUP BY 1)
    SELECT p_brand, hits, m AS names_matched, CASE WHEN nl > 0 AND hits >= 0.5 * least(nl, greatest(1, nr)) THEN 'id' WHEN e = 0 OR g = 0 THEN 'none' WHEN m < 0.98 * least(e, g) AND g >= 0.98 * e THEN 'count' ELSE 'name' END AS mode FROM ids JOIN nm USING (p_brand)""",
)
def g3(spark, d):
    line = load(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linestatus").join(load(spark, d, "part").select("p_partkey", "p_brand"), "p_partkey")
    ids = match.reconcile_within(line, ["p_brand", "l_orderkey"], _is_f()).groupBy("p_brand").agg(*(F.count(F.when(c, 1)).alias(n) for n, c in (("hits", F.col("status") == "both"), ("nl", F.col("status") != "only_right"), ("nr", F.col("status") != "only_left"))))
    names = match.counts_within(line, ["p_brand", "p_partkey"], _is_f()).groupBy("p_brand").agg(F.sum("matched").alias("names_matched"), F.sum("expected").alias("e"), F.sum("found").alias("g"))
    mode = match.adaptive_mode(F.col("hits"), F.col("nl"), F.col("nr"), F.col("names_matched"), F.col("e"), F.col("g"))
    return ids.join(names, "p_brand").select("p_brand", "hits", "names_matched", mode.alias("mode"))


def _graded(spark, d):
    """One row per part: coverage of its F lines by O lines, and flags of its lines as reasons, stand-ins, needs and issues."""
    n = lambda c: F.count(F.when(c, 1))
    line = load(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        n(F.col("l_linestatus") == "F").alias("e"), n(F.col("l_linestatus") == "O").alias("f"), n(F.col("l_discount") >= 0.1).alias("standins"), n(F.col("l_quantity") >= 49).alias("needs"), n((F.col("l_tax") >= 0.08) & (F.col("l_returnflag") == "R")).alias("issues")
    )
    part = load(spark, d, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    out = part.join(line, "p_partkey", "left").fillna(0, ["e", "f", "standins", "needs", "issues"])
    return out.withColumns({"coverage": S.floor_ratio(F.least("e", "f"), F.col("e")), "reasons": (F.col("p_size") >= 49).cast("int")})


_GRADED = """WITH l AS (SELECT l_partkey, count(*) FILTER (l_linestatus = 'F') AS e, count(*) FILTER (l_linestatus = 'O') AS f, count(*) FILTER (l_discount >= 0.1) AS s, count(*) FILTER (l_quantity >= 49) AS n, count(*) FILTER (l_tax >= 0.08 AND l_returnflag = 'R') AS i FROM lineitem GROUP BY 1),
    g AS (SELECT p_partkey, p_type, p_brand, CASE WHEN e <> 0 THEN floor(least(e, f) / e * 1e4) / 1e4 END AS cov, CASE WHEN p_size >= 49 THEN 1 ELSE 0 END AS r, coalesce(s, 0) AS s, coalesce(n, 0) AS n, coalesce(i, 0) AS i FROM part LEFT JOIN l ON l_partkey = p_partkey),
    k AS (SELECT *, CASE WHEN r > 0 OR coalesce(cov < 0.5, false) THEN 3 WHEN coalesce(cov < 1, false) OR s > 3 OR n > 2 OR i > 1 THEN 2 ELSE 1 END AS class FROM g)"""


def _classed(spark, d):
    g = _graded(spark, d)
    over = lambda c, n: F.greatest(F.lit(0), F.col(c) - n)
    return g.withColumn("class", grade.model_class(F.col("reasons"), F.col("coverage"), F.col("coverage"), over("standins", 3), over("needs", 2), over("issues", 1)))


@query(
    "g4_classify",
    _GRADED
    + """SELECT p_partkey, class, CASE WHEN class = 3 OR p_type LIKE 'ECONOMY%' THEN NULL WHEN p_brand LIKE '%1' THEN 'C' WHEN class = 1 THEN 'A' ELSE 'B' END AS corpus,
    CASE WHEN n = 0 AND s = 0 THEN 'complete_to_source' ELSE 'approximated' END AS partial FROM k""",
)
def g4(spark, d):
    c = _classed(spark, d)
    corpus = grade.corpus(F.col("class"), ~F.startswith("p_type", F.lit("ECONOMY")), ~F.endswith("p_brand", F.lit("1")))
    short = F.when(F.col("needs") > 0, F.array(F.lit("converter_feature"))).otherwise(F.array(F.lit("source_data_absent")))
    stand = F.when(F.col("standins") > 0, F.array(F.lit("bounding_box"))).otherwise(F.array(F.lit("brep_open_surface")))
    return c.select("p_partkey", "class", corpus.alias("corpus"), grade.partial_kind(short, stand).alias("partial"))


def _findings(spark, d):
    c = F.col
    rules = [
        ("F_PRICE", "FAIL", "PIPELINE", c("l_extendedprice") < 1000),
        ("F_SHA", "FAIL", "PACKAGING", (c("l_tax") >= 0.08) & (c("l_discount") >= 0.1)),
        ("W_EXTRA", "WARN", "UNCLASSIFIED", c("l_quantity") >= 48),
        ("W_OPEN", "WARN", "SOURCE", (c("l_returnflag") == "R") & (c("l_discount") == 0)),
        ("I_SKIPPED", "INFO", "SCOPE", c("l_returnflag") == "N"),
    ]
    return grade.findings(load(spark, d, "lineitem"), ["l_orderkey"], rules)


_FINDINGS = """WITH f AS (SELECT l_orderkey, 'F_PRICE' AS code, 'FAIL' AS level, 'PIPELINE' AS cause FROM lineitem WHERE l_extendedprice < 1000 UNION ALL SELECT l_orderkey, 'F_SHA', 'FAIL', 'PACKAGING' FROM lineitem WHERE l_tax >= 0.08 AND l_discount >= 0.1
    UNION ALL SELECT l_orderkey, 'W_EXTRA', 'WARN', 'UNCLASSIFIED' FROM lineitem WHERE l_quantity >= 48 UNION ALL SELECT l_orderkey, 'W_OPEN', 'WARN', 'SOURCE' FROM lineitem WHERE l_returnflag = 'R' AND l_discount = 0 UNION ALL SELECT l_orderkey, 'I_SKIPPED', 'INFO', 'SCOPE' FROM lineitem WHERE l_returnflag = 'N')"""


@query(
    "g5_verdict",
    _FINDINGS
    + """SELECT o_orderkey AS l_orderkey, CASE WHEN bool_or(level = 'FAIL') THEN 'FAIL' WHEN bool_or(level = 'WARN') THEN 'WARN' ELSE 'PASS' END AS verdict, coalesce(bool_or(level IN ('FAIL', 'WARN') AND cause IN ('PIPELINE', 'PACKAGING')), false) AS pipeline_issue, count(code) AS n_findings
    FROM orders LEFT JOIN f ON l_orderkey = o_orderkey GROUP BY 1""",
)
def g5(spark, d):
    return grade.verdict(_findings(spark, d), ["l_orderkey"], load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")))


@query(
    "g6_attribution",
    """WITH k AS (SELECT l_partkey, count(*) FILTER (l_linestatus = 'F') - count(*) FILTER (l_linestatus = 'O') AS deficit FROM lineitem GROUP BY 1), r AS (
      SELECT l.l_partkey, CASE WHEN l_discount >= 0.09 THEN 'BY_DESIGN' WHEN l_tax = 0 THEN 'SOURCE' ELSE 'PIPELINE' END AS cause, deficit, row_number() OVER (PARTITION BY l.l_partkey ORDER BY CASE WHEN l_discount >= 0.09 THEN 0 WHEN l_tax = 0 THEN 1 ELSE 2 END, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS rn
      FROM lineitem l JOIN k ON l.l_partkey = k.l_partkey WHERE l_linestatus = 'F' AND deficit > 0) SELECT cause, count(*) AS n, count(DISTINCT l_partkey) AS n_parts FROM r WHERE rn <= deficit GROUP BY 1""",
)
def g6(spark, d):
    line = load(spark, d, "lineitem").select("l_partkey", "l_linestatus", "l_discount", "l_tax", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    counts = match.counts_within(line, ["l_partkey"], _is_f()).filter("missing > 0").select("l_partkey", "missing")
    order = S.first_match([(F.col("l_discount") >= 0.09, 0), (F.col("l_tax") == 0, 1)], 2)
    cause = S.first_match([(order == 0, "BY_DESIGN"), (order == 1, "SOURCE")], "PIPELINE")
    rn = F.row_number().over(Window.partitionBy("l_partkey").orderBy(order, "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"))
    blamed = line.filter("l_linestatus = 'F'").join(counts, "l_partkey").withColumn("rn", rn).filter("rn <= missing")
    return blamed.groupBy(cause.alias("cause")).agg(F.count("*").alias("n"), F.countDistinct("l_partkey").alias("n_parts"))


@query(
    "g7_verify_merge",
    _GRADED
    + """, v AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'PASS' WHEN toxic = 1 THEN 'WARN' ELSE 'FAIL' END AS verdict, doc_id % 2 = 0 AS own FROM labels)
    SELECT p_partkey, class, CASE WHEN class <> 1 THEN class WHEN verdict IS NULL THEN 2 WHEN verdict = 'PASS' OR (verdict = 'WARN' AND own) THEN 1 ELSE 2 END AS merged,
    CASE WHEN class = 1 AND verdict IS NULL THEN 'class1_pending_verification' WHEN class = 1 AND NOT (verdict = 'PASS' OR (verdict = 'WARN' AND own)) THEN 'verifier_disagrees' END AS note FROM k LEFT JOIN v ON doc_id = p_partkey""",
)
def g7(spark, d):
    verdict = S.first_match([((F.col("quality") == 1) & (F.col("toxic") == 0), "PASS"), (F.col("toxic") == 1, "WARN")], "FAIL")
    checked = load(spark, d, "labels").select(F.col("doc_id").alias("p_partkey"), verdict.alias("verdict"), (F.col("doc_id") % 2 == 0).alias("own"))
    out = _classed(spark, d).select("p_partkey", "class").join(checked, "p_partkey", "left")
    out = out.withColumn("merged", grade.verify_merge(F.col("class"), F.col("verdict"), F.coalesce("own", F.lit(False))))
    return out.select("p_partkey", "class", "merged", grade.merge_note(F.col("class"), F.col("merged"), F.col("verdict")).alias("note"))


@query(
    "g8_transition_matrix",
    _GRADED
    + """, b AS (SELECT p_partkey, p_type, class AS before, CASE WHEN r > 0 OR coalesce(cov < 0.8, false) THEN 3 WHEN coalesce(cov < 1, false) OR s > 5 OR n > 4 OR i > 1 THEN 2 ELSE 1 END AS after FROM k)
    SELECT p_type, before, after, count(*) AS n FROM b GROUP BY 1, 2, 3""",
)
def g8(spark, d):
    c, over = _classed(spark, d), lambda c, n: F.greatest(F.lit(0), F.col(c) - n)
    worst = (F.col("reasons") > 0) | F.coalesce(F.col("coverage") < 0.8, F.lit(False))
    after = F.when(worst, 3).otherwise(grade.model_class(F.lit(0), F.lit(None).cast("double"), F.col("coverage"), over("standins", 5), over("needs", 4), over("issues", 1)))
    return c.select("p_type", F.col("class").alias("before"), after.alias("after")).groupBy("p_type", "before", "after").agg(F.count("*").alias("n"))


@query(
    "g9_ship_decision",
    _FINDINGS
    + """, c AS (SELECT l_orderkey, list(DISTINCT code) FILTER (level <> 'INFO') AS codes FROM f GROUP BY 1)
    SELECT o_orderkey AS l_orderkey, CASE WHEN codes IS NULL THEN 'ship' WHEN list_contains(codes, 'F_SHA') THEN 'hold' WHEN len(list_filter(codes, lambda x: x NOT IN ('W_EXTRA', 'W_OPEN'))) = 0 THEN 'ship_fixable' ELSE 'review' END AS decision FROM orders LEFT JOIN c ON l_orderkey = o_orderkey""",
)
def g9(spark, d):
    codes = _findings(spark, d).filter("level <> 'INFO'").groupBy("l_orderkey").agg(F.collect_set("code").alias("codes"))
    out = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")).join(codes, "l_orderkey", "left")
    failed = F.coalesce("codes", F.array().cast("array<string>"))
    return out.select("l_orderkey", grade.ship_decision(failed, ("F_SHA",), ("W_EXTRA", "W_OPEN")).alias("decision"))


@query(
    "g10_worst_severity",
    """WITH s AS (SELECT l_orderkey, CASE WHEN l_discount >= 0.1 THEN 4 WHEN l_tax >= 0.08 THEN 3 WHEN l_quantity >= 45 THEN 2 WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS r FROM lineitem)
    SELECT l_orderkey, CASE max(r) WHEN 4 THEN 'excluded' WHEN 3 THEN 'blocking' WHEN 2 THEN 'degraded' WHEN 1 THEN 'info' ELSE 'ok' END AS severity FROM s GROUP BY 1""",
)
def g10(spark, d):
    sev = S.first_match([(F.col("l_discount") >= 0.1, "excluded"), (F.col("l_tax") >= 0.08, "blocking"), (F.col("l_quantity") >= 45, "degraded"), (F.col("l_returnflag") == "R", "info")], "ok")
    return load(spark, d, "lineitem").groupBy("l_orderkey").agg(grade.worst_severity(sev).alias("severity"))


@query(
    "g11_bool_and_rollup",
    """WITH o AS (SELECT o_custkey, o_orderkey, coalesce(bool_and(l_discount < 0.1), true) AS ok FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
    SELECT o_custkey, bool_and(ok) AS ok, count(*) AS n_orders, count(*) FILTER (NOT ok) AS n_bad FROM o GROUP BY 1""",
)
def g11(spark, d):
    line = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_and(F.col("l_discount") < 0.1).alias("ok"))
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey").join(line, "o_orderkey", "left").withColumn("ok", F.coalesce("ok", F.lit(True)))
    return o.groupBy("o_custkey").agg(F.bool_and("ok").alias("ok"), F.count("*").alias("n_orders"), F.count(F.when(~F.col("ok"), 1)).alias("n_bad"))


@query(
    "g12_evidence_patch",
    """WITH a AS (SELECT doc_id AS k, min(sha256(text)) AS v FROM documents WHERE lang <> 'fr' GROUP BY 1), b AS (SELECT doc_id AS k, min(sha256(lower(text))) AS v FROM documents WHERE lang <> 'es' GROUP BY 1), e AS (SELECT DISTINCT doc_id AS k FROM labels WHERE toxic = 1)
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'add' WHEN b.k IS NULL THEN 'keep_missing' WHEN a.v = b.v THEN 'keep' WHEN e.k IS NOT NULL THEN 'replace' ELSE 'keep_warn' END AS action,
    CASE WHEN a.k IS NULL OR (b.k IS NOT NULL AND a.v <> b.v AND e.k IS NOT NULL) THEN b.v ELSE a.v END AS v FROM a FULL JOIN b ON a.k = b.k LEFT JOIN e ON e.k = coalesce(a.k, b.k)""",
)
def g12(spark, d):
    """Two versions of the documents (one language is new in the second, one is gone), with labels as the logged events."""
    docs = load(spark, d, "documents").select(F.col("doc_id").alias("k"), "lang", "text")
    one = lambda lang, v: docs.filter(F.col("lang") != lang).groupBy("k").agg(F.min(F.sha2(v, 256)).alias("v"))
    events = load(spark, d, "labels").filter("toxic = 1").select(F.col("doc_id").alias("k"))
    return grade.evidence_patch(one("fr", F.col("text")), one("es", F.lower("text")), events, "k", "v")


@query(
    "g13_finding_policy",
    _FINDINGS
    + """SELECT CASE WHEN code = 'F_PRICE' THEN 'NOTE' WHEN code = 'W_EXTRA' THEN 'INFO' ELSE level END AS level, cause, CASE WHEN code = 'F_SHA' THEN 'external' WHEN code LIKE 'W%' THEN 'decode' ELSE 'integrity' END AS evidence, count(*) AS n FROM f GROUP BY 1, 2, 3""",
)
def g13(spark, d):
    out = grade.finding_policy(_findings(spark, d), {"F_PRICE": "NOTE", "W_EXTRA": "INFO"}, {"F_SHA": "external", "W_EXTRA": "decode", "W_OPEN": "decode"})
    return out.groupBy("level", "cause", "evidence").agg(F.count("*").alias("n"))


@query(
    "g14_action_plan",
    """WITH h AS (SELECT sha256(text) AS sha, min(n_chars) AS size, min(lang) AS kind, min(doc_id) AS id FROM documents GROUP BY 1), dn AS (SELECT DISTINCT sha256(text) AS sha FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 1), q AS (SELECT DISTINCT sha256(text) AS sha FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 0)
    SELECT h.sha, CASE WHEN size = 0 THEN 'empty' WHEN kind = 'es' THEN 'excluded' WHEN dn.sha IS NOT NULL THEN 'reuse' WHEN q.sha IS NOT NULL THEN 'reuse_queued' WHEN id % 3 = 0 THEN 'unresolved' ELSE 'convert' END AS action FROM h LEFT JOIN dn ON dn.sha = h.sha LEFT JOIN q ON q.sha = h.sha""",
)
def g14(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "lang", "n_chars", F.sha2("text", 256).alias("sha"))
    rows = docs.groupBy("sha").agg(F.min("n_chars").alias("size"), F.min("lang").alias("kind"), F.when(F.min("doc_id") % 3 == 0, "unresolved").otherwise("real").alias("how"))
    labelled = docs.join(load(spark, d, "labels"), "doc_id")
    return resolve.action_plan(rows, "size", "kind", labelled.filter("quality = 1"), labelled.filter("quality = 0"), "how", "sha", ("es",)).select("sha", "action")
