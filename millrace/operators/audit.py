"""Audits: two-way differences, deltas, completeness, invariants, package and content dedup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def two_way_diff(left: DataFrame, right: DataFrame, keys: list[str], names=("only_left", "only_right")) -> DataFrame:
    """Keys of one side alone: two anti-joins on distinct keys."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("side", F.lit(names[0])).unionByName(b.join(a, keys, "left_anti").withColumn("side", F.lit(names[1])))


def delta_plan(current: DataFrame, ledger: DataFrame, key: str, mark: str) -> DataFrame:
    """add, remove_pending, refresh or keep for each key; removals are only listed."""
    a = current.select(key, F.col(mark).alias("_c"), F.lit(1).alias("_ic"))
    b = ledger.select(key, F.col(mark).alias("_l"), F.lit(1).alias("_il"))
    action = F.when(F.col("_il").isNull(), "add").when(F.col("_ic").isNull(), "remove_pending").when(~F.col("_c").eqNullSafe(F.col("_l")), "refresh").otherwise("keep")
    return a.join(b, key, "full").select(key, action.alias("action"))


def completeness(found: Column, expected: Column) -> Column:
    return F.when(expected.isNull(), "no_entry").when(found == expected, "match").when(found > expected, "more").otherwise("fewer")


def object_audit(rows: DataFrame, objects: DataFrame, key: str) -> DataFrame:
    """stored_ok, missing, or orphan for each key of either side."""
    a, b = rows.select(key).distinct().withColumn("_r", F.lit(1)), objects.select(key).distinct().withColumn("_o", F.lit(1))
    return a.join(b, key, "full").select(key, F.when(F.col("_o").isNull(), "missing").when(F.col("_r").isNull(), "orphan").otherwise("stored_ok").alias("state"))


def invariants(checks: list[tuple[str, DataFrame]], group: str, example: str, most: int = 50) -> DataFrame:
    """One row per check and group that violates it: the count, and the first examples in order.

    Examples are cut inside the aggregate's input by rank, so a group with many violations holds `most` of them at a time.
    """
    rows = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("check"), F.col(group).alias("grp"), F.col(example).cast("string").alias("example")) for name, df in checks])
    w = Window.partitionBy("check", "grp").orderBy("example")
    top = rows.withColumn("rn", F.row_number().over(w)).withColumn("example", F.when(F.col("rn") <= most, F.col("example")))
    return top.groupBy("check", "grp").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("example")), ",").alias("examples"))


def content_dedup(rows: DataFrame, content: list[str], order: list[Column], ident: str) -> DataFrame:
    """Of equal contents the first by `order` stays: each row with keep_id (the one that stays), n_copies, and whether it is `kept`.

    A back-reference is a row, so no list grows with the copies; the choice is an aggregate, where copies combine before the shuffle.
    """
    key = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)), F.col(ident).alias("id"))
    heads = rows.groupBy(*content).agg(F.min(key).alias("_m"), F.count("*").alias("n_copies"))
    heads = heads.select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(content)), F.col("_m.id").alias("keep_id"), "n_copies")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(content)))
    out = rows.join(heads, same).select(*rows.columns, "keep_id", "n_copies")
    return out.withColumn("kept", F.col(ident) == F.col("keep_id"))


def shortfalls(rows: DataFrame, by: list[str], ident: str, own: Column, most: int = 50) -> DataFrame:
    """Groups of shortfalls: n, the first ids (at most `most`), and pos: the source's own (`own`) last, the others by size."""
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(ident))
    counts = rows.groupBy(*by).agg(F.count("*").alias("n"), F.bool_or(own).alias("_own"))
    firsts = rows.withColumn("_rn", rn).filter(F.col("_rn") <= most).groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(ident)), ",").alias("ids"))
    pos = F.row_number().over(Window.orderBy("_own", F.desc("n"), *by))  # a row for each group
    return counts.join(firsts, by).withColumn("pos", pos).drop("_own")


def refresh_plan(source: DataFrame, copies: DataFrame, key: str, project: str, at: str = "modified", size: str = "size") -> DataFrame:
    """(project, key, state) of each copy: missing (no source), stale (the source is newer, or its size differs) or fresh."""
    a = source.select(key, F.col(at).alias("_sa"), F.col(size).alias("_ss"))
    out = copies.select(project, key, F.col(at).alias("_ca"), F.col(size).alias("_cs")).join(a, key, "left")
    stale = F.coalesce(F.col("_sa") > F.col("_ca"), F.lit(False)) | ~F.col("_ss").eqNullSafe(F.col("_cs"))
    return out.select(project, key, F.when(F.col("_ss").isNull() & F.col("_sa").isNull(), "missing").when(stale, "stale").otherwise("fresh").alias("state"))


def residual(packages: DataFrame, mapped: DataFrame, later: DataFrame, source: str) -> DataFrame:
    """Why a package's contents are or are not on a later disk, by its source's identity; adds `reason`.

    packages: source (null or empty: unknown), n_rows and other columns; mapped: source, rel and size; later: rel and size. One row a package.
    """
    m = mapped.groupBy(source).agg(F.min(F.struct("rel", "size")).alias("_m"))
    t = later.groupBy("rel").agg(F.max("size").alias("_later")).withColumn("_there", F.lit(True))
    out = packages.join(m, source, "left").withColumn("rel", F.col("_m.rel")).join(t, "rel", "left")
    reason = (
        F.when(F.coalesce("n_rows", F.lit(0)) == 0, "no_rows")
        .when(F.coalesce(F.col(source), F.lit("")) == "", "unknown_source")
        .when(F.col("_m").isNull(), "source_not_mapped")
        .when(F.col("_there").isNull(), "not_on_later_disk")
        .when(~F.col("_m.size").eqNullSafe(F.col("_later")), "later_copy_differs_size")
        .otherwise("same_size_on_later_disk")
    )
    return out.withColumn("reason", reason).select(*packages.columns, "reason")


def merge_split(parts: DataFrame, root: str, member: str, required: list[str]) -> DataFrame:
    """Halves united by root; complete only where every required member is there."""
    agg = parts.groupBy(root).agg(F.count("*").alias("n_parts"), *(F.bool_or(F.col(member) == r).alias(f"has_{r}") for r in required))
    return agg.withColumn("complete", reduce(lambda a, b: a & b, (F.coalesce(f"has_{r}", F.lit(False)) for r in required)))


def cross_group_copies(rows: DataFrame, content: str, group: str) -> DataFrame:
    """Contents found in two groups or more: rows, groups and extra copies."""
    agg = rows.groupBy(content).agg(F.count("*").alias("n_rows"), F.countDistinct(group).alias("n_groups"))
    return agg.filter("n_groups > 1").withColumn("extra", F.col("n_rows") - 1)


def known_before(rows: DataFrame, earlier: DataFrame, key: Column, earlier_key: Column, by: list[str], size: str) -> DataFrame:
    """Per group the rows whose content an earlier set holds, against all: counts and bytes."""
    have = earlier.select(earlier_key.alias("_k")).distinct().withColumn("_hit", F.lit(True))
    out = rows.withColumn("_k", key).join(have, "_k", "left")
    hit = F.coalesce("_hit", F.lit(False))
    return out.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum(hit.cast("long")).alias("n_known"), F.sum(F.when(hit, F.col(size)).otherwise(0)).alias("known_size"))
