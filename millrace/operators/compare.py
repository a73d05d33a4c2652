"""Two versions of a model, part by part: sets of parts, types, keys, end points and branches, with counters by type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import first_match

#: Parts that are no parts, those that are only counted, tolerance in millimetres, and the tolerance of bores.
SKIP = (
    "FLOW-ARROW", "END-POSITION-CLOSED", "END-POSITION-OPEN", "END-POSITION-NULL", "END-CONNECTION-PIPELINE", "END-CONNECTION-EQUIPMENT", "END-CONNECTION-NULL",
    "MESSAGE-SQUARE", "MESSAGE-CIRCLE", "MESSAGE-TRIANGLE", "MESSAGE-ROUND", "ISO-SPLIT-POINT", "DIMENSION",
)
ITEMS, TOLERANCE, BORE_TOLERANCE = ("WELD", "GASKET", "BOLT", "SUPPORT"), 1.0, 0.5
#: Kinds by how a type begins, in order, and kinds under another's name.
KINDS = ("VALVE", "INSTRUMENT", "FLANGE", "REDUCER", "TEE", "OLET", "ELBOW", "BEND", "PIPE")
SAME_KIND = {"BEND": "ELBOW"}
BRANCHED = ("TEE", "OLET", "TEE-STUB")


def kind_of(type_: Column) -> Column:
    t = F.upper(F.coalesce(type_, F.lit("")))
    return first_match([(t == "TEE-STUB", "TEE-STUB"), *((F.startswith(t, F.lit(k)), SAME_KIND.get(k, k)) for k in KINDS)], t)


def _parts(df: DataFrame) -> DataFrame:
    """One row per part: its first record's type and key, and the points of all its records (parts have a handful)."""
    df = df.filter(~F.coalesce(F.col("type").isin(*SKIP), F.lit(False)) & (F.coalesce("uci", F.lit("")) != ""))
    part = F.when(F.col("type") == "TEE-STUB", F.substring_index("uci", "-P", 1)).otherwise(F.col("uci"))
    flat = lambda c: F.flatten(F.collect_list(c)).alias(c)
    return df.groupBy(part.alias("part")).agg(F.min(F.struct("ord", "type", "skey")).alias("m"), flat("points"), flat("branches"))


def _apart(p: Column, q: Column) -> Column:
    return F.sqrt(sum(((p[a] - q[a]) * (p[a] - q[a]) for a in "yz"), (p["x"] - q["x"]) * (p["x"] - q["x"])))


def _nearest(p: Column, points: Column) -> Column:
    """The nearest of `points`: its distance and bore."""
    return F.array_min(F.transform(points, lambda q: F.struct(_apart(p, q).alias("d"), q["bore"].alias("bore"))))


def compare_parts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per part of either side.

    Both: uci, ord (the order of records), type, skey, points and branches (arrays of structs x, y, z, bore). status: both, only_left, only_right; item: only counted.
    same_kind, key_state (exact, wildcard, base, differs; null where a side has none), max_dev (the largest distance from a point to the nearest of the other side; of pipes, which
    the left side may split, only right points count), bore_ok and branch_ok. Null where there is nothing to compare.
    """
    a = _parts(left).select("part", F.col("m").alias("a"), F.col("points").alias("pa"), F.col("branches").alias("ba"))
    b = _parts(right).select("part", F.col("m").alias("b"), F.col("points").alias("pb"), F.col("branches").alias("bb"))
    j = a.join(b, "part", "full")
    status = F.when(F.col("b").isNull(), "only_left").when(F.col("a").isNull(), "only_right").otherwise("both")
    j = j.withColumns({"status": status, "item": F.coalesce("a.type", "b.type").isin(*ITEMS), "kind": kind_of(F.col("a.type")), "other": kind_of(F.col("b.type"))})
    ka, kb = F.col("a.skey"), F.col("b.skey")
    judged = (F.col("status") == "both") & ~F.coalesce("item", F.lit(False))
    base = F.substring(ka, 1, 2) == F.substring(kb, 1, 2)
    wild = F.endswith(ka, F.lit("**"))
    key = F.when((F.coalesce(ka, F.lit("")) != "") & (F.coalesce(kb, F.lit("")) != ""), F.when(ka == kb, "exact").when(wild & base, "wildcard").when(base, "base").otherwise("differs"))
    some = (F.size("pa") > 0) & (F.size("pb") > 0)
    back = F.array_max(F.transform("pb", lambda p: _nearest(p, F.col("pa"))["d"]))
    forth = F.array_max(F.transform("pa", lambda p: _nearest(p, F.col("pb"))["d"]))
    off = lambda p: F.coalesce((p["bore"] != 0) & (_nearest(p, F.col("pa"))["bore"] != 0) & (F.abs(p["bore"] - _nearest(p, F.col("pa"))["bore"]) > BORE_TOLERANCE), F.lit(False))
    branch = F.array_min(F.transform("ba", lambda q: _apart(F.get("bb", F.lit(0)), q)))
    return j.select(
        "part",
        "status",
        F.coalesce("item", F.lit(False)).alias("item"),
        F.when(F.col("a").isNull(), F.col("other")).otherwise(F.col("kind")).alias("kind"),
        F.when(judged, F.col("kind") == F.col("other")).alias("same_kind"),
        F.when(judged, key).alias("key_state"),
        F.when(judged & some, F.when(F.col("kind") == "PIPE", back).otherwise(F.greatest(back, forth))).alias("max_dev"),
        F.when(judged & some, ~F.exists("pb", off)).alias("bore_ok"),
        F.when(judged & F.col("kind").isin(*BRANCHED) & (F.size("ba") > 0) & (F.size("bb") > 0), branch <= TOLERANCE).alias("branch_ok"),
    )


def part_counters(parts: DataFrame) -> DataFrame:
    """Counters of compare_parts() by kind: one aggregate."""
    n = lambda c: F.count(F.when(c, 1))
    c, dev = F.col, F.col("max_dev")
    return parts.groupBy("kind", "item").agg(
        n(c("status") == "both").alias("matched"), n(c("status") == "only_left").alias("only_left"), n(c("status") == "only_right").alias("only_right"), n(c("same_kind")).alias("type_ok"), n(~c("same_kind")).alias("type_diff"),
        n(c("key_state").isNotNull()).alias("key_compared"), n(c("key_state").isin("exact", "wildcard")).alias("key_ok"), n(dev.isNotNull()).alias("points_compared"), n(dev <= TOLERANCE).alias("points_ok"), n(dev <= 5).alias("within_5"),
        n(dev <= 25).alias("within_25"), n(dev > 10).alias("beyond_10"), n(c("bore_ok")).alias("bore_ok"), n(c("branch_ok").isNotNull()).alias("branch_compared"), n(c("branch_ok")).alias("branch_ok"),
    )
