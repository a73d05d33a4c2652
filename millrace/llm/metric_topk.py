"""Exact top-k by inner product with M-trees and best-first search.

Vectors are cut into shards of a bounded number of rows, near vectors together; each shard becomes an M-tree of pages: a routing
entry has its centre, covering radius and distance to its parent's centre, a leaf entry its vector and distance to the
page's centre. For a query q and a ball (c, r), the inner product is at most <q,c> + |q| r; and as |<q,c> - <q,p>|
<= |q| d(c,p), the stored distance to the parent bounds an entry before <q,c> is computed. A search takes
pages best bound first and ends when no bound reaches the k-th best score so far. It starts from the k-th best
score among a fixed number of sampled rows, which is a lower bound of the true one.

Shards form groups, as many as there are shuffle partitions. A query goes to the groups that have a cell whose ball can reach its k-th
score, once to each; a group's trees go once to each block of queries, and a block has a bounded number of bytes. A task holds a block's queries and reads
the trees one by one, so what a tree finds raises the bounds for the next. So the rows that are shuffled grow with the table, and not with queries times shards.
Results are exact, ties included: a page is left out only if its bound is below the k-th score, and equal scores go to the smaller id.

Vectors that are null, or hold a null, NaN or infinity, take no part; nor do rows with a null id. Components are 64-bit numbers, and products that
64 bits can't hold are computed without limit; a scaled component, or a score among a group's k best, beyond 64 bits is an error, as the result's type can't hold it. Vectors of different lengths are
never compared. Repeated ids count as rows of their own (a query leaves out every row with its id, and each row with a
query's id is a query once per id and vector). An empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import Stash, partitions

K = 5
#: Rows in a shard at most (about), entries of a page, rows sampled for pivots and first thresholds.
SHARD, PAGE, SAMPLE = 16_384, 256, 512
#: Bytes of the queries that a task holds (about).
BLOCK = 8 << 20


def whole(x: bytes, dim: int) -> np.ndarray:
    """The integers of a packed vector: 32 bits each where all fit, else 64."""
    return np.frombuffer(x, "<i4" if len(x) == 4 * dim else "<i8").astype(np.int64)


def largest(x: np.ndarray) -> float:
    return float(np.abs(x.astype(float)).max(initial=0.0))


def kind_of(most: float):
    """How products are exact whose sums are up to `most`: as doubles, which are fast, in 64 bits, or as Python's integers."""
    return np.dtype(float) if most < 2.0**52 else np.dtype(np.int64) if most < 2.0**62 else np.dtype(object)


class MTree:
    """Bulk-loaded pages over integer vectors. Distances and bounds are kept a little large, so they stay valid in floating point."""

    SLACK = 1e-6

    def __init__(self, ids: np.ndarray, x: np.ndarray, page: int = PAGE):
        self.page, self.dim = page, x.shape[1]
        self.pages: list[tuple] = []  # (leaf?, centres or vectors, radii or ids, distance to this page's centre, child pages)
        self.root = None
        self.most = largest(x)
        # Integers beyond 2 ** 53 are rounded as doubles.
        self.fuzz = 0.0 if self.most < 2.0**53 else math.sqrt(max(1, self.dim)) * self.most * 2.0**-50
        if len(ids):
            x = x.astype(np.int32 if self.most < 2.0**31 else np.int64)
            centre = self._medoid(x)
            self.root = (centre, self._far(x, centre), self._build(ids, x, centre))

    @staticmethod
    def _medoid(x: np.ndarray) -> np.ndarray:
        f = x.astype(float)
        return x[int(((f - f.mean(0)) ** 2).sum(1).argmin())]

    def _dist(self, x: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.sqrt(((x.astype(float) - c.astype(float)) ** 2).sum(1)) * (1 + self.SLACK) + self.fuzz

    def _far(self, x, c):
        return float(self._dist(x, c).max())

    def _build(self, ids, x, centre) -> int:
        at = len(self.pages)
        self.pages.append(())
        if len(ids) <= self.page:
            self.pages[at] = (True, x, ids, self._dist(x, centre), None)
            return at
        n = min(self.page, -(-len(ids) // self.page))
        pivots, f = self._pivots(x, max(2, n)).astype(float), x.astype(float)
        part = ((pivots**2).sum(1)[None, :] - 2 * (f @ pivots.T)).argmin(1)
        groups = [np.flatnonzero(part == k) for k in range(len(pivots))]
        groups = [g for g in groups if len(g)]
        if len(groups) == 1:  # equal vectors: cut by position
            groups = np.array_split(np.arange(len(ids)), max(2, n))
        centres, radii, child = [], [], []
        for g in groups:
            c = self._medoid(x[g])
            centres.append(c), radii.append(self._far(x[g], c)), child.append(self._build(ids[g], x[g], c))
        centres = np.array(centres)
        self.pages[at] = (False, centres, np.array(radii), self._dist(centres, centre), child)
        return at

    @staticmethod
    def _pivots(x: np.ndarray, n: int) -> np.ndarray:
        """Distinct rows at even steps."""
        return np.unique(x[np.linspace(0, len(x) - 1, min(n, len(x))).astype(int)], axis=0)

    def ready(self) -> MTree:
        """Its vectors as doubles, where products with vectors of the same size are exact so: done once for many searches."""
        if kind_of(self.most * self.most * self.dim) == float:
            self.pages = [(leaf, rows.astype(float), *rest) for leaf, rows, *rest in self.pages]
        return self

    def tolerance(self, norm):
        """How far a bound for a query of this length may be off."""
        return 1e-9 * norm * (self.most + 1) * math.sqrt(max(1, self.dim))

    def search(self, q: np.ndarray, own: int, k: int, floor: int | None = None) -> list[tuple[int, int]]:
        """The k best (score, id) with scores of at least `floor`, leaving out rows with the id `own`. Best first."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id)
        if self.root is None:
            return []
        kind = kind_of(self.most * largest(q) * self.dim)
        floor = -math.inf if floor is None else floor
        norm = float(np.sqrt((q.astype(float) ** 2).sum())) * (1 + self.SLACK)
        slack = self.tolerance(norm)
        q = q.astype(kind)
        limit = lambda: max(floor, best[0][0]) if len(best) == k else floor
        centre, radius, root = self.root
        dot = float(centre.astype(kind) @ q) if self.dim else 0.0
        heap = [(-(dot + norm * radius), root, dot)]
        while heap:
            bound, at, dot = heapq.heappop(heap)
            if -bound < limit() - slack:
                break
            leaf, rows, other, apart, child = self.pages[at]
            rows = rows.astype(kind, copy=False)
            # Stored distances first: entries they rule out cost no inner product.
            ahead = dot + norm * (apart if leaf else apart + other) >= limit() - slack
            if not ahead.any():
                continue
            left = np.flatnonzero(ahead)
            score = rows @ q if 2 * len(left) > len(rows) else rows[left] @ q
            if len(score) > len(left):
                score = score[left]
            if leaf:
                ids = other[left]
                good = np.flatnonzero(np.asarray(score >= limit(), bool) & (ids != own))
                if len(good) > k:  # the k best of the page, ties to smaller ids
                    good = sorted(good, key=lambda i: (-score[i], ids[i]))[:k] if kind == object else good[np.lexsort((ids[good], -score[good]))[:k]]
                for i in good:
                    entry = (int(score[i]), -int(ids[i]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            else:
                score = score.astype(float)
                bounds = score + norm * other[left]
                for i in np.flatnonzero(bounds >= limit() - slack):
                    heapq.heappush(heap, (-float(bounds[i]), child[left[i]], float(score[i])))
        return [(s, -i) for s, i in sorted(best, key=lambda e: (-e[0], -e[1]))]


def _to_bytes(batches):
    """Packs integers as little-endian numbers, of 32 bits where a vector's all fit."""
    for b in batches:
        x = [np.array(v, "<i8") for v in b.column("v").to_pylist()]
        x = [v.astype("<i4").tobytes() if not len(v) or -(2**31) <= v.min() <= v.max() < 2**31 else v.tobytes() for v in x]
        yield pa.RecordBatch.from_pydict({"vec_id": b.column("vec_id"), "dim": b.column("dim"), "x": pa.array(x, pa.binary())})


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id, dim and x: floor(scale * component), component as double; rows that take no part are gone.

    A finite component of size 2**63 / scale or more is an error, not a row left out: scores are 64-bit numbers.
    """
    v = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    most = 2.0**63 / scale
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    fits = F.forall("v", lambda c: F.abs(c) < F.lit(most))
    ok = F.when(~finite, False).when(fits, True).otherwise(F.raise_error(F.lit(f"a vector has a finite component of size {most:.0f} or more")).cast("boolean"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null").filter(ok)
    ints = rows.select("vec_id", F.size("v").alias("dim"), F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("v"))
    return ints.mapInArrow(_to_bytes, "vec_id long, dim int, x binary")


def _assign(pivots):
    """Each row's cell (its nearest pivot; cell 0 of dimensions without pivots lies around the origin) and distance to it."""

    def run(batches):
        for b in batches:
            dims, xs = b.column("dim").to_numpy(), b.column("x").to_pylist()
            cell, apart = np.zeros(len(dims), "i4"), np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                p = pivots.value.get(int(dim), np.zeros((1, int(dim))))
                x = np.array([whole(xs[i], int(dim)) for i in at], float).reshape(len(at), int(dim))
                cell[at] = ((p**2).sum(1)[None, :] - 2 * x @ p.T).argmin(1)
                apart[at] = np.sqrt(((x - p[cell[at]]) ** 2).sum(1)) * (1 + MTree.SLACK) + np.abs(x).max(initial=0.0) * 2.0**-40
            yield pa.RecordBatch.from_pydict({n: b.column(n) for n in ("vec_id", "dim", "x", "row")} | {"cell": pa.array(cell), "apart": pa.array(apart)})

    return run


def _trees(key, pdf):
    import pandas as pd

    dim = int(pdf["dim"].iloc[0])
    pdf = pdf.sort_values(["vec_id", "row"], kind="stable")
    x = np.array([whole(v, dim) for v in pdf["x"]], np.int64).reshape(len(pdf), dim)
    return pd.DataFrame({"dim": [dim], "shard": [int(key[1])], "tree": [pickle.dumps(MTree(pdf["vec_id"].to_numpy(), x), protocol=5)]})


def _ask(k, sample, balls, deal):
    """Each query's first threshold, and the groups of shards that can reach it. deal: group by dimension and cell."""

    def run(batches):
        for b in batches:
            floors, to = [], []
            for own, dim, x in zip(b.column("vec_id").to_pylist(), b.column("dim").to_pylist(), b.column("x").to_pylist(), strict=True):
                q, known, floor = whole(x, dim), sample.value.get(dim), None
                if known is not None and dim:
                    ids, rows, most = known
                    kind = kind_of(most * largest(q) * dim)
                    s = (rows.astype(kind) @ q.astype(kind))[ids != own]
                    if len(s) >= k:
                        floor = int(sorted(s)[-k] if kind == object else np.partition(s, len(s) - k)[len(s) - k])
                        floor = floor if abs(floor) < 2**62 else None
                f = q.astype(float)
                norm = float(np.sqrt((f**2).sum())) * (1 + MTree.SLACK)
                centres, radii = balls.value[dim]
                reach = centres @ f + norm * radii + 1e-9 * norm * (np.sqrt((centres**2).sum(1)) + radii + 1)
                to.append(sorted({g for c in np.flatnonzero(reach >= floor) if (dim, c) in deal.value for g in deal.value[dim, c]} if floor is not None else {g for (d, _), gs in deal.value.items() if d == dim for g in gs}))
                floors.append(floor)
            yield pa.RecordBatch.from_pydict({n: b.column(n) for n in ("vec_id", "dim", "x")} | {"floor": pa.array(floors, pa.int64()), "groups": pa.array(to, pa.list_(pa.int32()))})

    return run


def _search(k):
    """Rows sorted by task, a block's queries ahead of its trees."""

    def run(batches):
        task, asked = None, {}

        def found():
            out = {n: [] for n in ("query_id", "x", "vec_id", "score")}
            for rows in asked.values():
                for own, x, _, _, best in rows:
                    for score, vec in best:
                        if abs(score) >= 2**63:
                            raise OverflowError(f"the score of {own} and {vec} doesn't fit 64 bits")
                        for c, v in zip(out.values(), (own, x, vec, score), strict=True):
                            c.append(v)
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_pydict({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds, strict=True)})

        for b in batches:
            for own, dim, x, floor, at in zip(*(b.column(n).to_pylist() for n in ("vec_id", "dim", "x", "floor", "task")), strict=True):
                if at != task:
                    if asked:
                        yield found()
                    task, asked = at, {}
                if own is not None:
                    asked.setdefault(dim, []).append([own, x, whole(x, dim), floor, []])
                    continue
                if not asked.get(dim):
                    continue
                tree, rows = pickle.loads(x).ready(), asked[dim]
                q = np.array([r[2] for r in rows], float).reshape(len(rows), dim)
                norm = np.sqrt((q**2).sum(1)) * (1 + MTree.SLACK)
                limit = np.array([-np.inf if r[3] is None else float(r[3]) for r in rows])
                reach = q @ tree.root[0].astype(float) + norm * tree.root[1] + tree.tolerance(norm)
                for r in [rows[i] for i in np.flatnonzero(reach >= limit)]:
                    got = tree.search(r[2], r[0], k, r[3])
                    if got:
                        r[4] = sorted([*r[4], *got], key=lambda e: (-e[0], e[1]))[:k]
                        if len(r[4]) == k:
                            r[3] = r[4][-1][0] if r[3] is None else max(r[3], r[4][-1][0])
        if asked:
            yield found()

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score over quantised() frames. Queries are distinct by id and vector."""
    spark = vectors.sparkSession
    stash = Stash(spark, "metric-topk")
    base = stash.put(vectors.withColumn("row", F.monotonically_increasing_id()))
    order = F.sha2(F.concat(F.lit("pivot|"), F.col("vec_id").cast("string")), 256)
    taken: dict[int, list] = {}
    for r in base.orderBy(order, "vec_id", "row").limit(SAMPLE).collect():
        taken.setdefault(r["dim"], []).append((r["vec_id"], whole(bytes(r["x"]), r["dim"])))
    sample = {d: (np.array([i for i, _ in v]), x := np.array([x for _, x in v]), largest(x)) for d, v in taken.items()}
    pivots = {d: x[: max(1, len(x) // 4)].astype(float) for d, (_, x, _) in sample.items()}
    cells = stash.put(base.mapInArrow(_assign(spark.sparkContext.broadcast(pivots)), "vec_id long, dim int, x binary, row long, cell int, apart double"))
    # Cells are dealt into shards of even size: large ones cut by a hash of the row, small ones joined.
    sizes = sorted((r["dim"], r["cell"], r["n"], r["r"]) for r in cells.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("apart").alias("r")).collect())  # at most SAMPLE / 4 cells a dimension
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    tasks = partitions(spark)
    shard_rows = max(1, min(shard_rows, -(-sum(n for _, _, n, _ in sizes) // tasks)))
    first, cuts, now, room = {}, {}, -1, 0
    for dim, cell, n, _ in sizes:
        if n >= shard_rows:
            first[dim, cell], cuts[dim, cell] = now + 1, -(-n // shard_rows)
            now, room = now + cuts[dim, cell], 0
        else:
            if n > room or (dim, -1) not in first:
                now, room = now + 1, shard_rows
            first[dim, cell], cuts[dim, cell], first[dim, -1] = now, 1, now
            room -= n
    groups = min(now + 1, tasks)
    in_group = lambda shard: shard * groups // (now + 1)  # neighbours together
    spread = spark.sparkContext.broadcast((first, cuts))

    def dealt(batches):
        f, c = spread.value
        for b in batches:
            rows, keys = b.column("row").to_numpy(), list(zip(b.column("dim").to_pylist(), b.column("cell").to_pylist(), strict=True))
            mixed = (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            shard = [f[key] + int(m) % c[key] for key, m in zip(keys, mixed, strict=True)]
            yield pa.RecordBatch.from_pydict({n: b.column(n) for n in ("vec_id", "dim", "x", "row")} | {"shard": pa.array(shard, pa.int32())})

    rows = cells.mapInArrow(dealt, "vec_id long, dim int, x binary, row long, shard int")
    index = stash.put(rows.groupBy("dim", "shard").applyInPandas(_trees, "dim int, shard int, tree binary"))
    balls = {d: (pivots.get(d, np.zeros((1, d))), np.zeros(len(pivots.get(d, [0])))) for d, *_ in sizes}
    for dim, cell, _, r in sizes:
        balls[dim][1][cell] = r
    deal = {(d, c): sorted({in_group(first[d, c] + i) for i in range(cuts[d, c])}) for d, c, *_ in sizes}
    put = spark.sparkContext.broadcast
    asked = queries.select("vec_id", "dim", "x").dropDuplicates(["vec_id", "x", "dim"]).filter(F.col("dim").isin(list(balls)))
    asked = stash.put(asked.mapInArrow(_ask(k, put(sample), put(balls), put(deal)), "vec_id long, dim int, x binary, floor long, groups array<int>"))
    n_blocks = max(1, -(-(asked.agg(F.sum(F.length("x"))).first()[0] or 0) // block))
    blocks = F.pmod(F.xxhash64("vec_id", "x"), F.lit(n_blocks)).cast("int")
    asks = asked.select("vec_id", "dim", "x", "floor", blocks.alias("block"), F.explode("groups").alias("group"))
    group = F.floor(F.col("shard") * F.lit(groups) / F.lit(now + 1)).cast("int")
    trees = index.select(F.lit(None).cast("long").alias("vec_id"), "dim", F.col("tree").alias("x"), F.lit(None).cast("long").alias("floor"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), group.alias("group"))
    stream = asks.unionByName(trees).withColumn("task", F.col("group") * F.lit(n_blocks) + F.col("block"))
    stream = stream.repartitionById(groups * n_blocks, "task").sortWithinPartitions("task", F.col("vec_id").asc_nulls_last())
    found = stream.select("vec_id", "dim", "x", "floor", "task").mapInArrow(_search(k), "query_id long, x binary, vec_id long, score long")
    best = Window.partitionBy("query_id", "x").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2_metric_topk(spark, sf_dir):
    x = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(x, x.filter(F.col("vec_id") % 50 == 0))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
