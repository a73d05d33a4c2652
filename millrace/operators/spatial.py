"""Spatial joins by grid cells, range joins by buckets, group geometry and votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.order import ranked, slices


def cells(df: DataFrame, axes: list[str], size: float) -> DataFrame:
    return df.withColumn("_cell", F.array(*(F.floor(F.col(a) / size).cast("long") for a in axes)))


def _around(n: int) -> Column:
    """All offsets of -1, 0 and 1 on n axes."""
    out = [[]]
    for _ in range(n):
        out = [[*x, d] for x in out for d in (-1, 0, 1)]
    return F.array(*(F.array(*(F.lit(d).cast("long") for d in x)) for x in out))


def radius_join(left: DataFrame, right: DataFrame, axes: list[str], radius: float, on: list[str] = ()) -> DataFrame:
    """Pairs within `radius`, with dist; l_ and r_ before the columns.

    Right rows stand in their cell, left rows look into the cells around theirs: an equi-join on the cell, then the exact test.
    """
    a = cells(left, axes, radius).withColumn("_cell", F.explode(F.transform(_around(len(axes)), lambda o: F.zip_with(o, F.col("_cell"), lambda x, y: x + y))))
    b = cells(right, axes, radius)
    a = a.select(*(F.col(c).alias(f"l_{c}") for c in left.columns), "_cell")
    b = b.select(*(F.col(c).alias(f"r_{c}") for c in right.columns), F.col("_cell").alias("_rcell"))
    cond = F.col("_cell") == F.col("_rcell")
    for c in on:
        cond = cond & (F.col(f"l_{c}") == F.col(f"r_{c}"))
    d2 = sum(((F.col(f"l_{x}") - F.col(f"r_{x}")) * (F.col(f"l_{x}") - F.col(f"r_{x}")) for x in axes[1:]), (F.col(f"l_{axes[0]}") - F.col(f"r_{axes[0]}")) * (F.col(f"l_{axes[0]}") - F.col(f"r_{axes[0]}")))
    return a.join(b, cond).drop("_cell", "_rcell").withColumn("dist", F.sqrt(d2)).filter(F.col("dist") <= radius)


def nearest(pairs: DataFrame, key: str, other: str) -> DataFrame:
    """The nearest partner of each key (ties: the least id), from radius_join()."""
    return pairs.groupBy(key).agg(F.min(F.struct("dist", other)).alias("m")).select(key, F.col(f"m.{other}").alias(other), F.col("m.dist").alias("dist"))


def greedy_one_to_one(pairs: DataFrame, left: str, right: str, by: list[str] = ("dist",)) -> DataFrame:
    """One-to-one matches: pairs that are each other's best, then again among the rest, until none is left.

    The same matches as taking pairs by (by, left, right) one at a time, in a few rounds, each written to the shared folder.
    Copies of a point tie with each other and take a round each; match_points() takes them together.
    """
    from millrace.session import Stash

    stash = Stash(pairs.sparkSession, "one-to-one")
    columns = list(dict.fromkeys([*by, left, right]))
    rest, hits, i = stash.put(pairs.select(*columns)), stash.path(), 0
    order = F.min(F.struct(*columns)).alias("m")
    while True:
        a = rest.groupBy(left).agg(order).select("m.*")
        b = rest.groupBy(right).agg(order).select("m.*")
        hit = stash.put(a.join(b, columns).withColumn("round", F.lit(i)), f"{hits}/{i}")
        if rest.isEmpty():  # the last round's table is empty, so that there is one even without pairs
            return pairs.sparkSession.read.schema(hit.schema).parquet(f"{hits}/*")
        rest, before = stash.put(rest.join(hit.select(left), left, "left_anti").join(hit.select(right), right, "left_anti")), rest
        stash.drop(before)
        i += 1


def match_passes(left: DataFrame, right: DataFrame, axes: list[str], ident: str, measure: str, dist_tol: float, measure_tol: float, near_tol: float, k: int = 12) -> DataFrame:
    """Matches in two passes: close pairs of the same measure first (`exact`), then what is left within `near_tol` (`near`).

    Candidates are the k nearest left rows of each right row. Within a pass pairs go by (dist, difference of measures, left id, right id), one to one.
    """
    from millrace.session import Stash

    stash = Stash(left.sparkSession, "passes")
    cand = radius_join(left, right, axes, near_tol)
    lm, rm = F.col(f"l_{measure}"), F.col(f"r_{measure}")
    ratio = F.when(rm > 0, lm / rm).when(lm == 0, 1.0)
    rn = F.row_number().over(Window.partitionBy(f"r_{ident}").orderBy("dist", f"l_{ident}"))
    cand = cand.withColumn("rn", rn).filter(F.col("rn") <= k).withColumn("ratio", ratio).withColumn("off", F.coalesce(F.when(F.col("ratio") > 0, F.abs(F.log("ratio"))), F.lit(99.0)))
    cand = stash.put(cand.select(f"l_{ident}", f"r_{ident}", "dist", "off", "ratio"))
    same = (F.col("dist") <= dist_tol) & F.coalesce(F.abs(F.col("ratio") - 1) <= measure_tol, F.lit(False))
    first = greedy_one_to_one(cand.filter(same), f"l_{ident}", f"r_{ident}", ["dist", "off"])
    rest = cand.join(first.select(f"l_{ident}"), f"l_{ident}", "left_anti").join(first.select(f"r_{ident}"), f"r_{ident}", "left_anti")
    second = greedy_one_to_one(rest, f"l_{ident}", f"r_{ident}", ["dist", "off"])
    told = lambda df, kind: df.select(f"l_{ident}", f"r_{ident}", "dist", F.lit(kind).alias("pass"))
    return told(first, "exact").unionByName(told(second, "near"))


def match_points(left: DataFrame, right: DataFrame, axes: list[str], radius: float, ident: str) -> DataFrame:
    """l_, r_ and dist of the one-to-one matches of greedy_one_to_one() over radius_join(), with copies of a point taken together.

    Points meet, not rows: a point stands for its copies, which go in the order of `ident` (no id twice on a side). Two points that are each other's
    nearest, and have no other point as near, match as many copies at once as both still have. Where several points are
    exactly as near, one copy goes a round, as the next ids decide. Rounds go on until no pair is left.
    """
    from millrace.session import Stash

    spark, point = left.sparkSession, F.array(*(F.col(a) + 0.0 for a in axes))  # -0.0 is 0.0
    stash = Stash(spark, "points")

    def side(df, p):
        ok = df.filter(" and ".join(f"abs({a}) < double('infinity')" for a in axes)).select(F.col(ident).alias("_id"), point.alias("_at"))
        rows = stash.put(ranked(ok, ["_at"], [F.col("_id")]).select(F.col("_id").alias(f"{p}_{ident}"), F.col("_at").alias(f"{p}_at"), F.col("rank").alias(f"{p}_rank")))
        points = rows.groupBy(f"{p}_at").agg(F.count("*").alias("n"), F.min(f"{p}_{ident}").alias("head"))
        return rows, points.select(F.col(f"{p}_at").alias("at"), "n", "head", F.lit(0).cast("long").alias("used"), *(F.col(f"{p}_at")[i].alias(a) for i, a in enumerate(axes)))

    (lrows, lpoints), (rrows, rpoints) = side(left, "l"), side(right, "r")
    state = [f"{p}_{c}" for p in "lr" for c in ("at", "n", "head", "used")]
    rest, hits, i = stash.put(radius_join(lpoints, rpoints, axes, radius).select(*state, "dist")), stash.path(), 0

    def best(p):
        """Each point's least pair, and whether it is the only one at that distance."""
        pair = ["l_head", "r_head", "l_at", "r_at"]
        out = rest.groupBy(f"{p}_at").agg(F.min(F.struct("dist", *pair)).alias("m"), F.max(F.struct((-F.col("dist")).alias("d"), *pair)).alias("x"))
        return out.select("m.l_at", "m.r_at", ((F.col("m.l_at") == F.col("x.l_at")) & (F.col("m.r_at") == F.col("x.r_at"))).alias(f"{p}_only"))

    def spent(df, hit, rows, p):
        """The pairs with what the round took of side p's points; points without copies left are gone."""
        took = hit.select(f"{p}_at", "k", (F.col(f"{p}_used") + F.col("k") + 1).alias(f"{p}_rank")).join(rows, [f"{p}_at", f"{p}_rank"], "left")
        took = took.select(f"{p}_at", "k", F.col(f"{p}_{ident}").alias("_next"))
        out = df.join(took, f"{p}_at", "left").filter(f"k is null or {p}_used + k < {p}_n")
        return out.withColumn(f"{p}_head", F.coalesce("_next", f"{p}_head")).withColumn(f"{p}_used", F.col(f"{p}_used") + F.coalesce("k", F.lit(0))).drop("k", "_next")

    while True:
        k = F.when(F.col("l_only") & F.col("r_only"), F.least(F.col("l_n") - F.col("l_used"), F.col("r_n") - F.col("r_used"))).otherwise(F.lit(1).cast("long"))
        hit = stash.put(best("l").join(best("r"), ["l_at", "r_at"]).join(rest, ["l_at", "r_at"]).withColumn("k", k).select("l_at", "r_at", "l_used", "r_used", "dist", "k"), f"{hits}/{i}")
        if rest.isEmpty():
            break
        rest, before = stash.put(spent(spent(rest, hit, lrows, "l"), hit, rrows, "r").select(*state, "dist")), rest
        stash.drop(before)
        i += 1
    every = spark.read.schema(hit.schema).parquet(f"{hits}/*")
    # Long runs of copies are cut before they are spread, so that no task spreads a whole one.
    runs = every.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), "k", F.lit(4096).cast("long")))).repartition("l_at", "_from")
    runs = runs.withColumn("_i", F.explode(F.sequence("_from", F.least("k", F.col("_from") + 4095))))
    out = runs.select("l_at", (F.col("l_used") + F.col("_i")).alias("l_rank"), "r_at", (F.col("r_used") + F.col("_i")).alias("r_rank"), "dist")
    return out.join(lrows, ["l_at", "l_rank"]).join(rrows, ["r_at", "r_rank"]).select(f"l_{ident}", f"r_{ident}", "dist")


def range_join(left: DataFrame, right: DataFrame, value: str, tolerance: float, extra: Column | None = None) -> DataFrame:
    """Pairs whose values differ by at most `tolerance` (l_ and r_ columns): buckets as wide as the tolerance, and the neighbours."""
    b = F.floor(F.col(value) / tolerance).cast("long")
    a = left.withColumn("_b", F.explode(F.array(b - 1, b, b + 1))).select(*(F.col(c).alias(f"l_{c}") for c in left.columns), "_b")
    c = right.withColumn("_rb", b).select(*(F.col(x).alias(f"r_{x}") for x in right.columns), "_rb")
    out = a.join(c, F.col("_b") == F.col("_rb")).drop("_b", "_rb").filter(F.abs(F.col(f"l_{value}") - F.col(f"r_{value}")) <= tolerance)
    return out if extra is None else out.filter(extra)


def tolerance_join(left: DataFrame, right: DataFrame, tolerances: dict[str, tuple[float, float]]) -> DataFrame:
    """Pairs (l_, r_) where for each column |l - r| <= max(absolute, relative * |r|).

    An equi-join on cells of the first column, whose width grows with the value: on the scale of `_scale` every tolerance is about as wide, so a right row stands in a
    handful of cells whatever its value. All columns are tested behind it.
    """
    (first, (absolute, relative)), *_ = tolerances.items()

    def scale(v):
        bend = absolute / relative if relative else float("inf")
        if not relative:
            return v / absolute
        return F.when(F.abs(v) <= bend, v / absolute).otherwise(F.signum(v) * (1 + F.log(F.abs(v) / bend)) / relative)

    tol = lambda c, a, r: F.greatest(F.lit(float(a)), F.abs(c) * r)
    cell = lambda v: F.floor(scale(v)).cast("long")
    v = F.col(first)
    a = left.filter(v.isNotNull()).select(*(F.col(c).alias(f"l_{c}") for c in left.columns), cell(v).alias("_c"))
    b = right.filter(v.isNotNull()).withColumn("_d", F.explode(F.sequence(cell(v - tol(v, absolute, relative)) - 1, cell(v + tol(v, absolute, relative)) + 1)))
    b = b.select(*(F.col(c).alias(f"r_{c}") for c in right.columns), "_d")
    out = a.join(b, F.col("_c") == F.col("_d")).drop("_c", "_d")
    for c, (x, r) in tolerances.items():
        out = out.filter(F.abs(F.col(f"l_{c}") - F.col(f"r_{c}")) <= tol(F.col(f"r_{c}"), x, r))
    return out


def boxes(df: DataFrame, by: list[str], axes: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*(f(a).alias(f"{a}_{n}") for a in axes for f, n in ((F.min, "lo"), (F.max, "hi"))))


def overlapping(left: DataFrame, right: DataFrame, axes: list[str], size: float, ident: str) -> DataFrame:
    """Pairs of closed boxes that overlap (l_, r_): boxes stand in every cell of the first axis that they reach, and a pair counts in the first cell they share."""
    lo, hi = f"{axes[0]}_lo", f"{axes[0]}_hi"
    spread = lambda df, p, c: df.withColumn(c, F.explode(F.sequence(F.floor(F.col(lo) / size).cast("long"), F.floor(F.col(hi) / size).cast("long")))).select(*(F.col(x).alias(f"{p}_{x}") for x in df.columns), c)
    out = spread(left, "l", "_c").join(spread(right, "r", "_d"), F.col("_c") == F.col("_d"))
    out = out.filter(F.col("_c") == F.greatest(F.floor(F.col(f"l_{lo}") / size), F.floor(F.col(f"r_{lo}") / size)).cast("long"))
    for a in axes:
        out = out.filter((F.col(f"l_{a}_lo") <= F.col(f"r_{a}_hi")) & (F.col(f"r_{a}_lo") <= F.col(f"l_{a}_hi")))
    return out.drop("_c", "_d")


def group_geometry(df: DataFrame, by: list[str], axes: list[str], weight: str, digits: int = 4) -> DataFrame:
    """Weighted centroid, total weight and box of each group."""
    centre = [F.round(F.sum(F.col(weight) * F.col(a)) / F.sum(weight), digits).alias(f"c_{a}") for a in axes]
    box = [F.round(f(a), digits).alias(f"{a}_{n}") for a in axes for f, n in ((F.min, "lo"), (F.max, "hi"))]
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.sum(weight), digits).alias("total"), *centre, *box)


def offset_vote(df: DataFrame, by: list[str], offset: Column, step: float) -> DataFrame:
    """The most frequent rounded offset of each group (ties: the least) and its votes."""
    votes = df.withColumn("vote", F.floor(offset / step + 0.5).cast("long")).groupBy(*by, "vote").agg(F.count("*").alias("_c"))
    return votes.groupBy(*by).agg(F.min(F.struct((-F.col("_c")).alias("c"), "vote")).alias("m")).select(*by, F.col("m.vote").alias("vote"), (-F.col("m.c")).alias("votes"))


def mesh_volume(triangles: DataFrame, by: list[str]) -> DataFrame:
    """Volume of closed meshes from triangles (ax..cz), by the divergence theorem."""
    c = F.col
    det = c("ax") * (c("by") * c("cz") - c("bz") * c("cy")) - c("ay") * (c("bx") * c("cz") - c("bz") * c("cx")) + c("az") * (c("bx") * c("cy") - c("by") * c("cx"))
    return triangles.groupBy(*by).agg(F.abs(F.sum(det) / 6).alias("volume"))


def tiles(df: DataFrame, axes: list[str], order: str, ident: str, size: float, n: int) -> DataFrame:
    """Equal slices in spatial order: by cell, then the last axis, then id. A global order without a task that gets all rows, or all cells."""
    return slices(cells(df, axes, size), [], [F.col("_cell"), F.col(order), F.col(ident)], n, "tile").drop("_cell")
