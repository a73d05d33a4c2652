"""Resolution of stored content: priorities, proofs, ambiguity, paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import key_kind


def priority_resolve(wanted: DataFrame, key: str, tiers: list[tuple[str, DataFrame]], value: str) -> DataFrame:
    """The value of the first tier that has the key (ties: the least value) and `how`, the tier's name, or unresolved.

    Each tier is reduced to one row per key before they meet, so a key in many rows joins once.
    """
    ranked = [df.groupBy(key).agg(F.min(value).alias(value)).select(key, F.lit(i).alias("_rank"), F.lit(name).alias("how"), value) for i, (name, df) in enumerate(tiers)]
    best = reduce(DataFrame.unionByName, ranked).groupBy(key).agg(F.min(F.struct("_rank", value, "how")).alias("m"))
    return wanted.join(best, key, "left").withColumns({value: F.col("m")[value], "how": F.coalesce(F.col("m")["how"], F.lit("unresolved"))}).drop("m")


def resolve_keys(contents: DataFrame, ident: str, keys: str, size: str, root: str, markers: DataFrame, others: list[tuple[str, DataFrame, bool]]) -> DataFrame:
    """Adds place and how: where a content is stored, by the kinds of its keys, and then by maps.

    In order: the least real key under `root` (disk_real), the least source pointer (disk_source), a marker's target where a key points to one (disk_marker), then each map of `others`
    (name, frame of ident, place and size, must the size agree); else unresolved. keys: an array of strings.
    """
    kind = key_kind(F.col("_key"))
    flat = contents.select(ident, F.explode(keys).alias("_key"))
    least = lambda c, v=F.col("_key"): F.min(F.when(c, v))
    own = flat.groupBy(ident).agg(
        least((kind == "real") & F.startswith("_key", F.lit(root.rstrip("/") + "/"))).alias("_real"),
        least(kind == "source", F.substring("_key", 5, 1 << 20)).alias("_source"),
        F.bool_or(kind == "marker").alias("_marked"),
    )
    out = contents.join(own, ident, "left").join(markers.groupBy(ident).agg(F.min("place").alias("_target")), ident, "left")
    tries = [("disk_real", F.col("_real")), ("disk_source", F.col("_source")), ("disk_marker", F.when(F.col("_marked"), F.col("_target")))]
    for i, (name, places, sized) in enumerate(others):
        by = [ident, size] if sized else [ident]
        out = out.join(places.groupBy(*by).agg(F.min("place").alias(f"_o{i}")), by, "left")
        tries.append((name, F.col(f"_o{i}")))
    how = F.lit("unresolved")
    for name, v in reversed(tries):
        how = F.when(v.isNotNull(), name).otherwise(how)
    return out.select(*contents.columns, F.coalesce(*(v for _, v in tries)).alias("place"), how.alias("how"))


def proof_gate(asks: DataFrame, offers: DataFrame, weak: list[str], proof: str) -> DataFrame:
    """Candidates by weak keys that count only if the proof agrees too. Reason: proven, no_candidate, or proof_differs.

    Offers are reduced to distinct proofs per weak key, and never expanded: the proven ones are found by an equi-join on both.
    """
    have = offers.select(*weak).distinct().withColumn("_some", F.lit(True))
    sure = offers.select(*weak, proof).distinct().withColumn("_sure", F.lit(True))
    out = asks.join(have, weak, "left").join(sure, [*weak, proof], "left")
    return out.withColumn("reason", F.when(F.col("_sure"), "proven").when(F.col("_some"), "proof_differs").otherwise("no_candidate")).drop("_some", "_sure")


def ambiguous_lookup(asks: DataFrame, offers: DataFrame, key: str, value: str, exact: Column | None = None) -> DataFrame:
    """One candidate wins; of several, one that is `exact` (over the columns of both); else ambiguous, or not_found."""
    n = offers.groupBy(key).agg(F.count("*").alias("_n"), F.min(value).alias("_one"))
    out = asks.join(n, key, "left")
    hit = F.lit(None).cast("string") if exact is None else exact
    return out.withColumns(
        {
            "status": F.when(F.col("_n").isNull(), "not_found").when(F.col("_n") == 1, "unique").when(hit.isNotNull(), "exact").otherwise("ambiguous"),
            "choice": F.when(F.col("_n") == 1, F.col("_one")).when(F.col("_n") > 1, hit),
            "candidates": F.coalesce("_n", F.lit(0)),
        }
    ).drop("_n", "_one")


def parent_of(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def sibling_join(asks: DataFrame, offers: DataFrame, path: str, scopes: dict[str, str] | None = None) -> DataFrame:
    """Rows of `offers` in the same folder as an ask, in a named subfolder of it, or in its parent, with the scope's label."""
    scopes = scopes or {"same": "", "parent": ".."}
    here = parent_of(F.col(path))
    dirs = F.array(*(F.struct(F.lit(s).alias("scope"), (here if not sub else parent_of(here) if sub == ".." else F.concat(here, F.lit("/" + sub))).alias("dir")) for s, sub in scopes.items()))
    a = asks.select("*", F.explode(dirs).alias("_d")).select(*asks.columns, "_d.scope", "_d.dir")
    b = offers.withColumn("dir", parent_of(F.col(path))).withColumnRenamed(path, f"peer_{path}")
    return a.join(b, "dir")


def action_plan(rows: DataFrame, size: str, kind: str, done: DataFrame, queued: DataFrame, how: str, key: str, excluded=("excluded",)) -> DataFrame:
    """empty, excluded, reuse, reuse_queued, convert or unresolved for each content."""
    d = done.select(key).distinct().withColumn("_done", F.lit(True))
    q = queued.select(key).distinct().withColumn("_queued", F.lit(True))
    out = rows.join(d, key, "left").join(q, key, "left")
    action = F.when(F.col(size) == 0, "empty").when(F.col(kind).isin(*excluded), "excluded").when(F.col("_done"), "reuse").when(F.col("_queued"), "reuse_queued").when(F.col(how) == "unresolved", "unresolved").otherwise("convert")
    return out.withColumn("action", action).drop("_done", "_queued")


def best_of(df: DataFrame, keys: list[str], order: list[Column], ident: str) -> DataFrame:
    """Marks the best row of each key (`best`), tells the others by which row they are superseded, and all how many candidates there were."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rn = F.row_number().over(w)
    return df.withColumns({"best": rn == 1, "superseded_by": F.when(rn > 1, F.first(ident).over(whole)), "candidates": F.count("*").over(whole)})


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order`: an aggregate with map-side combining, no window."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    one = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("m"))
    return one.select(*keys, *(F.col(f"m.{c}").alias(c) for c in df.columns if c not in keys))
