"""Quality rules, and an isolation forest on their statistics.

Words are runs of anything but space and \\x09-\\x0D. Each text is counted whole: words, code points in words,
symbols, repeated lines, and words in five-word windows found twice or more. Plain limits make `base_failed`. The
forest (trees of random splits; by the method, each is grown on a draw of DRAW rows, here from all labelled documents) gives each document an anomaly
score by its path lengths; the threshold is the one that best parts good from bad labelled rows while at least KEEP of the good rows pass,
both among all the labelled rows that pass the plain limits: the others are gone in any case, and their scores would set the cut. Every fifth labelled id is
left out of both, so that the verdict can be judged on rows it has not seen. Where an id has several labels, the largest holds; all documents of an id count in the threshold,
and equal ones are one row for the draws.

Null and empty texts have no words, so they fail the base rules. Null ids, repeated rows and ties stay, row by row. Texts of any length
count whole: time and memory grow with a text's words, and a batch of Arrow rows is the largest unit held. An empty table gives no rows.
Without labelled rows the threshold lets all pass. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.learning import held_out
from millrace.llm.near_dedup import mix, unit
from millrace.operators.order import running
from millrace.session import Stash

TREES, DRAW, SEED = 100, 256, 11
#: Share of good labelled rows that must pass.
KEEP = 0.995
MIN_WORDS, MAX_REPEAT = 10, 20

_WORD = re.compile(r"[^ \t-\r]+")
_BLANKS, _SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[str], width: int = 5) -> int:
    """Words in windows of `width` words found twice or more in the text, first finds included. Exact."""
    if len(words) <= width:
        return 0
    order: dict[str, int] = {}
    ids = np.array([order.setdefault(w, len(order)) for w in words], np.int64)
    n = len(order)
    if n == len(words):
        return 0
    key, top = ids[: len(ids) - width + 1].copy(), n
    for k in range(1, width):
        if top * n >= 2**62:  # rank what has been joined so far
            _, key = np.unique(key, return_inverse=True)
            top = int(key.max()) + 1
        key = key * n + ids[k : len(ids) - width + 1 + k]
        top *= n
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = count[back] > 1
    if not hit.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = _WORD.findall(text)
    chars = len(text) - sum(map(text.count, _BLANKS))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(_BLANKS):
            seen.add(line)
    return len(words), chars, sum(map(text.count, _SYMBOLS)), dup, repeated_words(words)


def statistics(text: str | None, base: tuple[int, ...]) -> tuple[float, ...]:
    """What the forest sees: rates of the base counts, and shares of letter cases and punctuation."""
    n, chars, symbols, dup, repeat = base
    text = text or ""
    size = max(1, len(text))
    lines = text.count("\n") + 1
    return (
        math.log1p(n),
        chars / max(1, n),
        symbols / max(1, n),
        dup / lines,
        repeat / max(1, n),
        n / lines,
        text.count("!") / max(1, n),
        text.count("|") / max(1, n),
        (text.count(",") + text.count(".")) / max(1, n),
        len(text.encode()) / size,
        sum(map(text.count, "ETAONISR")) / size,
        sum(map(text.count, "0123456789")) / size,
    )


N_STATS = 12


class Forest:
    """Isolation forest as flat arrays: feature, cut, children and, at leaves, the path length."""

    def __init__(self, x: np.ndarray, trees: int = TREES, draw: int = DRAW, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self._plant((x[rng.choice(len(x), min(draw, len(x)), replace=False)] for _ in range(trees if len(x) else 0)), min(draw, len(x)), rng)

    @classmethod
    def of(cls, draws: list[np.ndarray], seed: int = SEED) -> Forest:
        """A tree for each draw."""
        made = cls.__new__(cls)
        made._plant(draws, max(map(len, draws), default=0), np.random.default_rng(seed))
        return made

    def _plant(self, draws, size, rng):
        self.norm = self.expected(size)
        limit = math.ceil(math.log2(max(2, size)))
        self.trees = [self._grow(rows, rng, limit) for rows in draws]

    @staticmethod
    def expected(n: int) -> float:
        """Mean path length of an unsuccessful search in a binary search tree of n."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, x, rng, limit):
        feature, cut, left, right, depth = [], [], [], [], []

        def node(rows, d):
            at = len(feature)
            for to, v in zip((feature, cut, left, right, depth), (-1, 0.0, at, at, d + self.expected(len(rows))), strict=True):
                to.append(v)
            lo, hi = rows.min(0), rows.max(0)
            open_ = np.flatnonzero(hi > lo)
            if d < limit and len(rows) > 1 and len(open_):
                f = int(rng.choice(open_))
                c = float(rng.uniform(lo[f], hi[f]))
                feature[at], cut[at] = f, c
                left[at] = node(rows[rows[:, f] < c], d + 1) if (rows[:, f] < c).any() else at
                right[at] = node(rows[rows[:, f] >= c], d + 1) if (rows[:, f] >= c).any() else at
                if left[at] == at or right[at] == at:
                    feature[at], left[at], right[at] = -1, at, at
            return at

        node(x, 0)
        return tuple(np.array(v) for v in (feature, cut, left, right, depth))

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 for anomalies."""
        if not self.trees or not len(x):
            return np.zeros(len(x))
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, left, right, depth in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                down = np.where(x[rows, np.maximum(f, 0)] < cut[at], left[at], right[at])
                at = np.where(inner, down, at)
            total += depth[at]
        return 2.0 ** (-(total / len(self.trees)) / max(self.norm, 1e-9))


def threshold(scored: DataFrame, keep: float = KEEP) -> float:
    """The score from which documents go: the cut with the best balanced accuracy among those that let `keep` of the good rows pass.

    scored: anomaly, and y, 1 for good rows. Exact over all rows, by running sums over ranges of scores.
    """
    by = scored.groupBy("anomaly").agg(F.sum((F.col("y") == 1).cast("long")).alias("good"), F.sum((F.col("y") != 1).cast("long")).alias("bad"))
    up = running(by, [], [F.col("anomaly")], F.col("good"), "stay", "all_good")
    up = running(up, [], [F.col("anomaly")], F.col("bad"), "low", "all_bad")
    up = Stash(scored.sparkSession, "quality").put(up)
    total = up.agg(F.max("all_good"), F.max("all_bad")).first()
    good, bad = total[0] or 0, total[1] or 0
    if not good:
        return math.inf
    least = up.filter(F.col("stay") > math.ceil((good - 1) * keep)).agg(F.min("anomaly")).first()[0]
    if not bad:
        return float(np.nextafter(least, math.inf))
    cuts = up.filter(F.col("anomaly") > least)
    value = (F.lit(bad) - F.col("low") + F.col("bad")) / F.lit(bad) + (F.col("stay") - F.col("good")) / F.lit(good)
    best = cuts.agg(F.max(F.struct(value, -F.col("anomaly")))).first()[0]
    return math.inf if best is None else -best[1]


def _drawn(share, trees, seed):
    """Of each tree, the rows whose number for it is below `share`."""
    trees = mix(np.arange(trees, dtype=np.uint64) + np.uint64(seed << 32))

    def run(batches):
        for b in batches:
            u = unit(mix(b.column("h").to_numpy().astype(np.uint64)[:, None] ^ trees))
            row, tree = np.nonzero(u < share)
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(u[row, tree]), b.column("stats").take(pa.array(row))], ["tree", "u", "stats"])

    return run


def draws(rows: DataFrame, trees: int = TREES, draw: int = DRAW, seed: int = SEED) -> list[np.ndarray]:
    """For each tree the `draw` rows of `rows` (distinct doc_id and stats) with the least of random numbers, which hang on the row and the tree alone.

    All rows have the same chance; some more than are needed reach the driver, a number that doesn't grow with the table.
    """
    n = rows.count()
    share = (draw + 6 * math.sqrt(draw)) / max(1, n)
    while n:
        got = rows.select(F.xxhash64("doc_id", "stats").alias("h"), "stats").mapInArrow(_drawn(share, trees, seed), "tree int, u double, stats array<double>").collect()
        by: list[list] = [[] for _ in range(trees)]
        for r in got:
            by[r["tree"]].append((r["u"], r["stats"]))
        if share >= 1 or all(len(x) >= draw for x in by):
            return [np.array([x for _, x in sorted(own)[:draw]], float) for own in by]
        share *= 2
    return []


def _stats(carry):
    names = [*BASE]

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            base = [base_counts(t) for t in texts]
            rows = [statistics(t, x) for t, x in zip(texts, base, strict=True)]
            cols = {c: b.column(c) for c in carry}
            cols |= {n: pa.array([x[i] for x in base], pa.int64()) for i, n in enumerate(names)}
            cols["stats"] = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict(cols)

    return run


def _judge(forest, names):
    def run(batches):
        model = forest.value
        for b in batches:
            x = np.array(b.column("stats").to_pylist(), float).reshape(-1, N_STATS)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(model.anomaly(x))], [*names, "anomaly"])

    return run


def judge_quality(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """One row per document: doc_id, the base counts, anomaly, base_failed and kept. All labelled rows outside the held-out fold make the forest and the cut."""
    spark = docs.sparkSession
    stash = Stash(spark, "quality")
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = ", ".join(f"{n} long" for n in BASE)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    stats = docs.select("doc_id", "text").mapInArrow(_stats(["doc_id"]), f"doc_id {kind}, {base}, stats array<double>")
    every = stash.put(stats.join(known, "doc_id", "left").select("doc_id", *BASE, "y", "stats"))
    rows = stash.put(every.filter("y is not null").select("doc_id", "stats").distinct())
    model = spark.sparkContext.broadcast(Forest.of(draws(rows)))
    judged = stash.put(every.mapInArrow(_judge(model, ["doc_id", *BASE, "y"]), f"doc_id {kind}, {base}, y int, anomaly double"))
    stash.drop(every, rows)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    cut = threshold(judged.filter(F.col("y").isNotNull() & ~failed).select("anomaly", "y"), keep)
    return judged.drop("y").withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < float(cut)))


def op6_quality_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return judge_quality(docs, labels).select("doc_id", *BASE, "base_failed", "kept", "anomaly")
