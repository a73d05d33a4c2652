"""Scalar functions and small operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import sample, spatial, text
from millrace.plans.registry import query
from millrace.session import load


@query(
    "a20_apply_rules",
    """WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS rn, sum(n) OVER (PARTITION BY p_brand) AS total FROM c)
    SELECT p_partkey, rule, rule = part.p_type AS agrees FROM part LEFT JOIN (SELECT p_brand, p_type AS rule FROM r WHERE rn = 1 AND total >= 20 AND n / total >= 0.2) x ON x.p_brand = part.p_brand""",
)
def a20(spark, d):
    """Majority rules learned from all parts, applied to each."""
    part = load(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    return sample.apply_majority(part, sample.majority_rules(part, ["p_brand"], "p_type", 20, 0.2), ["p_brand"], "p_type").select("p_partkey", "rule", "agrees")


@query("t5_redact_values", "SELECT doc_id, md5(replace(replace(text, 'the ' || source, '[X]'), source, '[X]')) AS redacted FROM documents")
def t5(spark, d):
    """Literal values of each row, the longest first; a language code is too short to be one."""
    values = F.array("source", F.concat(F.lit("the "), "source"), "lang")
    return load(spark, d, "documents").select("doc_id", F.md5(text.redact_values(F.col("text"), values)).alias("redacted"))


@query(
    "f7_codecs",
    "SELECT p_partkey, lower(hex(p_name)) AS hex, CAST(CASE p_size % 4 WHEN 0 THEN p_size + 0.5 WHEN 1 THEN p_size / 8.0 WHEN 2 THEN p_size + 0.25 END AS DOUBLE) AS size FROM part",
)
def f7(spark, d):
    size = F.col("p_size").cast("string")
    told = S.first_match([(F.col("p_size") % 4 == 0, F.concat(size, F.lit(" 1/2"))), (F.col("p_size") % 4 == 1, F.concat(size, F.lit("/8"))), (F.col("p_size") % 4 == 2, F.concat(size, F.lit(".25")))], "none")
    return load(spark, d, "part").select("p_partkey", S.base64_to_hex(F.base64(F.col("p_name"))).alias("hex"), S.fraction(told).alias("size"))


@query(
    "p6_key_kinds",
    """SELECT doc_id, CASE CAST(substr(source, 4) AS INT) % 6 WHEN 0 THEN 'source' WHEN 1 THEN 'marker' WHEN 2 THEN 'other_disk' WHEN 3 THEN 'prior' WHEN 4 THEN 'real' ELSE 'empty' END AS kind FROM documents""",
)
def p6(spark, d):
    n = F.substring("source", 4, 9).cast("int") % 6
    key = S.first_match([(n == i, F.concat(F.lit(p), F.col("lang"))) for i, p in enumerate(("src:", "sha256:", "disk12:", "prior:", "root/"))], F.when(F.col("lang") == "fr", ""))
    return load(spark, d, "documents").select("doc_id", S.key_kind(key).alias("kind"))


@query(
    "p7_measures",
    """WITH t AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag FROM lineitem)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice, l_quantity >= 2 AND l_returnflag <> 'R' AND NOT (coalesce(abs(l_quantity - 20) <= 1, false)) AS solid,
    CASE WHEN l_tax >= 0.02 AND l_discount > 0 THEN l_discount WHEN l_tax < 0.02 AND l_discount > 0 AND l_returnflag = 'N' THEN l_discount ELSE l_extendedprice END AS measure FROM t""",
)
def p7(spark, d):
    c = F.col
    solid = S.is_solid(F.when(c("l_quantity") >= 2, 1).otherwise(0), c("l_quantity") - 20, c("l_returnflag") == "R")
    measure = S.expected_measure(c("l_discount"), c("l_extendedprice"), F.when(c("l_tax") >= 0.02, 2), F.when(c("l_returnflag") == "N", "I").otherwise("T"))
    return load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice", solid.alias("solid"), measure.alias("measure"))


@query(
    "x11_mesh_volume",
    """WITH t AS (SELECT label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings)
    SELECT label, round(abs(sum(e[1] * (e[5] * e[9] - e[6] * e[8]) - e[2] * (e[4] * e[9] - e[6] * e[7]) + e[3] * (e[4] * e[8] - e[5] * e[7])) / 6), 6) AS volume FROM t GROUP BY 1""",
)
def x11(spark, d):
    """Each vector's first nine components as a triangle."""
    at = {f"{p}{a}": F.element_at("embedding", 3 * i + j + 1).cast("double") for i, p in enumerate("abc") for j, a in enumerate("xyz")}
    triangles = load(spark, d, "embeddings").select("label", *(v.alias(k) for k, v in at.items()))
    return spatial.mesh_volume(triangles, ["label"]).select("label", F.round("volume", 6).alias("volume"))
