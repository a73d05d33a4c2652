"""Attribute tables (EAV), typed edges and hierarchies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ident: str, columns: list[str]) -> DataFrame:
    """(ident, attr, value): one row per attribute that isn't null, values as strings. One scan."""
    pairs = F.array(*(F.struct(F.lit(c).alias("attr"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(ident, F.explode(pairs).alias("p")).select(ident, "p.attr", "p.value").filter("value is not null")


def union_typed(tables: dict[str, DataFrame]) -> DataFrame:
    """Typed attribute tables (oid, iid, dispid, value) as one, with the type's name."""
    rows = [df.select("oid", "iid", "dispid", F.col("value").cast("string").alias("value"), F.lit(t).alias("type")) for t, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def pivot(eav: DataFrame, ident: str, attributes: list[str]) -> DataFrame:
    """Back to one row per object; with the attributes given no pass is needed to find them."""
    return eav.groupBy(ident).pivot("attr", attributes).agg(F.max("value"))


def attribute_map(eav: DataFrame, ident: str, names: DataFrame, code: str = "attr", codelist: DataFrame | None = None) -> DataFrame:
    """A map of attribute name to value per object: codes resolved by `names` (code, name), values decoded by `codelist` (code, value, label)."""
    out = eav.join(names, code, "left").withColumn("name", F.coalesce("name", F.col(code)))
    if codelist is not None:
        out = out.join(codelist, [code, "value"], "left").withColumn("value", F.coalesce("label", "value"))
    one = out.groupBy(ident, "name").agg(F.min("value").alias("value"))
    return one.groupBy(ident).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "value")))).alias("attributes"))


def ancestors(nodes: DataFrame, child: str, parent: str, guard: int = 50) -> DataFrame:
    """(node, up): each node's ancestors, the nearest first, at most `guard` and one more if there are more; a parent that is no child of its own row ends the way.

    By doubling: each round joins the ways so far to themselves and is written to the shared folder, so a hierarchy of any size takes a handful of joins. A child
    with several parents goes by the least. A way through a cycle goes round it, up to the guard.
    """
    from millrace.session import Stash

    stash = Stash(nodes.sparkSession, "ancestors")
    one = nodes.select(F.col(child).cast("string").alias("node"), F.col(parent).cast("string").alias("up")).filter("node is not null").groupBy("node").agg(F.min("up").alias("up"))
    known = one.select(F.col("node").alias("up"))
    empty = F.array().cast("array<string>")
    ways = one.join(known, "up", "left_semi").select("node", F.array("up").alias("up")).unionByName(one.join(known, "up", "left_anti").select("node", empty.alias("up")))
    ways, length = stash.put(ways), 1
    while length <= guard:
        full = F.size("up") == length
        longer = ways.filter(full).withColumn("_last", F.element_at("up", -1)).join(ways.select(F.col("node").alias("_last"), F.col("up").alias("_more")), "_last")
        longer = longer.select("node", F.slice(F.concat("up", "_more"), 1, guard + 1).alias("up"))
        now = stash.put(ways.filter(~full).unionByName(longer))
        stash.drop(ways)
        ways, length = now, 2 * length
        if ways.filter(F.size("up") == length).isEmpty():
            break
    return ways


def paths_to_root(nodes: DataFrame, child: str, parent: str, guard: int = 50) -> DataFrame:
    """Each node's path from its root, depth, and `cut` where the guard or a cycle ended it (a path holds a node once)."""
    ways = ancestors(nodes, child, parent, guard)
    trail = F.concat(F.array("node"), "up")
    # Up to the first node that the way has met before.
    new = F.filter(F.sequence(F.lit(1), F.size("trail")), lambda i: F.array_position(F.col("trail"), F.element_at(F.col("trail"), i)) < i)
    rows = ways.select("node", trail.alias("trail")).withColumn("again", F.get(new, F.lit(0)))
    rows = rows.withColumn("kept", F.slice("trail", F.lit(1), F.least(F.coalesce(F.col("again") - 1, F.size("trail")), F.lit(guard + 1))))
    cut = F.col("again").isNotNull() | (F.size("trail") > guard)
    return rows.select("node", F.array_join(F.reverse("kept"), "/").alias("path"), (F.size("kept") - 1).alias("depth"), cut.alias("cut"))


def descendants(nodes: DataFrame, child: str, parent: str, guard: int = 50) -> DataFrame:
    """(node, depth, n_descendants, n_leaves) of every node: how far it lies below its root, and what lies below it, each counted once, up to the guard."""
    ways = ancestors(nodes, child, parent, guard).withColumn("up", F.array_except("up", F.array("node")))  # distinct, and a cycle doesn't lead to itself
    inner = nodes.select(F.col(parent).cast("string").alias("node")).distinct()
    tips = ways.join(inner, "node", "left_anti").select("node").withColumn("tip", F.lit(1))
    below = ways.join(tips, "node", "left").select(F.explode("up").alias("node"), F.coalesce("tip", F.lit(0)).alias("tip"))
    counts = below.groupBy("node").agg(F.count("*").alias("n"), F.sum("tip").alias("t"))
    out = ways.select("node", F.size("up").alias("depth")).join(counts, "node", "left")
    return out.select("node", "depth", F.coalesce("n", F.lit(0)).alias("n_descendants"), F.coalesce("t", F.lit(0)).alias("n_leaves"))


def leaves(nodes: DataFrame, child: str, parent: str) -> DataFrame:
    return nodes.join(nodes.select(F.col(parent).alias(child)).distinct(), child, "left_anti")


def two_hops(edges: DataFrame, first: str, second: str) -> DataFrame:
    """src to dst over a middle node, by the two relations' types."""
    a = edges.filter(F.col("rel") == first).select("src", F.col("dst").alias("mid"))
    b = edges.filter(F.col("rel") == second).select(F.col("src").alias("mid"), "dst")
    return a.join(b, "mid").select("src", "mid", "dst")


def neighbourhood(edges: DataFrame, target_kind: str = "dst") -> DataFrame:
    """Edges in and out by relation: count, and the least other end as a sample. One scan, two directions."""
    both = F.array(F.struct(F.lit("out").alias("direction"), F.col("dst").alias("other")), F.struct(F.lit("in").alias("direction"), F.col("src").alias("other")))
    rows = edges.select("rel", F.explode(both).alias("d")).select("rel", "d.direction", "d.other")
    return rows.groupBy("direction", "rel").agg(F.count("*").alias("n"), F.min("other").alias("sample"), F.countDistinct("other").alias("n_nodes"))
