"""Deterministic samples, ranks, chunks and islands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.order import running


def draw(seed: str, ident: Column) -> Column:
    """A portable order for sampling: the sha256 of seed and id."""
    return F.sha2(F.concat(F.lit(f"{seed}|"), ident.cast("string")), 256)


def hash_sample(df: DataFrame, strata: list[str], ident: str, k: int, seed: str) -> DataFrame:
    """k rows of each stratum, by hash order."""
    w = Window.partitionBy(*strata).orderBy(draw(seed, F.col(ident)), ident)
    return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)


def quota_sample(df: DataFrame, stratum: str, ident: str, total: int, seed: str, truth: Column | None = None) -> DataFrame:
    """Proportional quotas, one at least per stratum (rounded down), by hash order. truth: half of a quota (rounded up) goes to rows where it holds, as far as there are any."""
    sizes = df.groupBy(stratum).agg(F.count("*").alias("_n"))
    everything = sizes.agg(F.sum("_n").alias("_all"))
    quota = F.greatest(F.lit(1), F.floor(F.lit(total) * F.col("_n") / F.col("_all")).cast("long"))
    sizes = sizes.join(F.broadcast(everything)).select(stratum, quota.alias("quota"))  # one row
    by = [draw(seed, F.col(ident)), F.col(ident)]
    # No quota is above `total`, so tasks hand on no more rows of a stratum than that.
    if truth is None:
        first = df.withColumn("rn", F.row_number().over(Window.partitionBy(stratum).orderBy(*by))).filter(F.col("rn") <= max(1, total))
        return first.join(sizes, stratum).filter("rn <= quota")
    rows = df.withColumn("_true", F.coalesce(truth, F.lit(False)))
    place = F.row_number().over(Window.partitionBy(stratum, "_true").orderBy(*by))
    rows = rows.withColumn("_place", place).filter(F.col("_place") <= max(1, total)).join(sizes, stratum)
    early = F.col("_true") & (F.col("_place") <= F.ceil(F.col("quota") / 2))
    rn = F.row_number().over(Window.partitionBy(stratum).orderBy(F.when(early, 0).otherwise(1), *by))
    return rows.withColumn("rn", rn).filter("rn <= quota").drop("_true", "_place")


def round_robin(df: DataFrame, stratum: str, ident: str, n: int, seed: str) -> DataFrame:
    """n rows by turns: every stratum's first, then every second, small strata first within a turn."""
    w = Window.partitionBy(stratum).orderBy(draw(seed, F.col(ident)), ident)
    sizes = df.groupBy(stratum).agg(F.count("*").alias("_size"))
    turns = df.withColumn("turn", F.row_number().over(w)).filter(F.col("turn") <= n).join(sizes, stratum)
    return turns.orderBy("turn", "_size", stratum).limit(n).drop("_size")


def lower_rank(df: DataFrame, by: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Quantiles by the lower rank, int(q * (n - 1)): an actual value, not an interpolated one.

    Ranks come from running counts per distinct value, so equal values combine before the shuffle, and no task sorts a whole group.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    upto = running(counts, by, [F.col(value)], F.col("_c"), "_hi", "_n")
    pick = lambda q: F.min(F.when(F.col("_hi") > F.floor(F.lit(q) * (F.col("_n") - 1)), F.col(value)))
    return upto.groupBy(*by).agg(F.max("_n").alias("n"), *(pick(q).alias(name) for name, q in quantiles.items()))


def mode_of(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Most common value (ties: the least), its count, the number of variants, and the group's size."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_c"))
    agg = counts.groupBy(*by).agg(F.min(F.struct((-F.col("_c")).alias("c"), F.col(value).alias("v"))).alias("m"), F.count("*").alias("variants"), F.sum("_c").alias("n"))
    return agg.select(*by, F.col("m.v").alias("mode"), (-F.col("m.c")).alias("mode_n"), "variants", "n")


def majority_rules(df: DataFrame, by: list[str], value: str, least_n: int, least_share: float) -> DataFrame:
    """(by, rule, share): the most common value of groups of at least `least_n` rows in which it has the share."""
    m = mode_of(df, by, value).withColumn("share", F.col("mode_n") / F.col("n"))
    return m.filter((F.col("n") >= least_n) & (F.col("share") >= least_share)).select(*by, F.col("mode").alias("rule"), "share")


def apply_majority(df: DataFrame, rules: DataFrame, by: list[str], value: str) -> DataFrame:
    """Adds each row's rule (null where its group has none), and whether its own value agrees."""
    return df.join(rules.select(*by, "rule"), by, "left").withColumn("agrees", F.col("rule") == F.col(value))


def islands(df: DataFrame, by: list[str], at: Column, order: list[str], gap: Column | float) -> DataFrame:
    """Numbers runs of rows: a new one where `at` is more than `gap` behind the row before."""
    w = Window.partitionBy(*by).orderBy(*order)
    new = F.coalesce((at - F.lag(at).over(w) > gap).cast("int"), F.lit(0))
    return df.withColumn("_new", new).withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def blocks(df: DataFrame, by: list[str], order: list[str], starts: Column) -> DataFrame:
    """Numbers records that begin at each row where `starts` holds; rows before the first are block 0."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("block", F.sum(starts.cast("int")).over(w))


def bounded_chunks(df: DataFrame, by: list[str], order: list[str], weight: str, limit: int) -> DataFrame:
    """Sequential chunks of at most `limit` weight; a heavier row is ceil(weight / limit) chunks of its own (`parts`).

    The restart makes it sequential within a group: rows come as Arrow batches, ordered in the task, and one running sum is held.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def run(batches):
        group, chunk, held = None, 0, 0
        for pdf in batches:
            out_c, out_p = [], []
            weights = pdf[weight].fillna(0).astype("int64").tolist()
            for w, key in zip(weights, zip(*(pdf[c].tolist() for c in by), strict=True), strict=True):
                if group is None or key != group:
                    group, chunk, held = key, 0, 0
                parts = max(1, -(-w // limit))
                if parts > 1:
                    chunk += held > 0
                    out_c.append(chunk), out_p.append(parts)
                    chunk, held = chunk + parts, 0
                    continue
                if held and held + w > limit:
                    chunk, held = chunk + 1, 0
                held += w
                out_c.append(chunk), out_p.append(1)
            yield pdf.assign(chunk=out_c, parts=out_p)

    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInPandas(run, f"{fields}, chunk long, parts long")


def sticky(choices: DataFrame, previous: DataFrame, key: str, value: str, order: list[Column]) -> DataFrame:
    """The previous choice of a key where it is still offered, else the first by `order`; `kept` tells which."""
    w = Window.partitionBy(key).orderBy(F.coalesce(F.col("_was"), F.lit(False)).desc(), *order)
    was = previous.select(key, value).distinct().withColumn("_was", F.lit(True))
    out = choices.join(was, [key, value], "left").withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    return out.select(key, value, F.coalesce("_was", F.lit(False)).alias("kept"))
