"""Mixing to target weights with soft domain membership.

A classifier fitted on a bounded sample of labelled rows gives each document a posterior over the domains. Document rates r >= 0 are then
sought such that the expected tokens of each domain, sum of r n p_k, come to the target's share of the total. They minimise the
squared gap to the targets, each domain's gap by its target, plus a small pull of every rate to `start`. A document's rate depends
on the corpus only through one number per domain, so an iteration is one aggregate over all documents: Newton steps on those numbers
(meet_targets), or projected gradient steps (solve_rates). Nothing but totals and their derivatives leaves the executors.

A row whose text is null or has no words has no tokens and gets rate `start`. Rows are treated one by one, so
repeated rows, equal ids and null ids get the same rate. Labels that are null, and labelled ids without a document, are left out; without
any labelled row each domain is equally likely. An empty table gives no rows.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import packed, unpacked
from millrace.llm.learning import labelled_sample
from millrace.session import Stash

TRAIN_ROWS = 20_000
STEPS, PULL = 40, 0.01
#: meet_targets(): share of its target by which a total may miss it, steps under one pull, and the weakest pull.
TOLERANCE, MOST_STEPS, LEAST_PULL = 1e-3, 30, 1e-6
#: The domains by label value, with their target shares of all tokens.
DOMAINS = ("low", "high")
TARGETS = (0.08, 0.92)

N_FEATURES = 14
_CAPS, _VOWELS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "aeiou"


def features(text: str | None) -> tuple[float, ...]:
    """Rates over the whole text that separate prose from junk."""
    text = text or ""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    lines = text.split("\n")
    return (
        math.log1p(len(words)),
        size / n,
        len(set(words)) / n,
        len(set(lines)) / len(lines),
        len(words) / len(lines),
        sum(map(text.count, "#*$%&|<>")) / n,
        text.count("!") / n,
        text.count("|") / n,
        (text.count(".") + text.count(",")) / n,
        sum(map(text.count, _CAPS)) / size,
        sum(map(text.count, "0123456789")) / size,
        sum(map(text.count, _VOWELS)) / size,
        float(len(words) < 10),
        float(len(text.encode()) - len(text)) / size,
    )


def _features(carry):
    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carry), pa.array([len((t or "").split()) for t in texts], pa.int64()), pa.array([features(t) for t in texts], pa.list_(pa.float64()))], [*carry, "n", "x"])

    return run


class Softmax:
    """Multinomial logistic regression on standardised features and their squares, by gradient descent from zero."""

    def __init__(self, x: np.ndarray, y: np.ndarray, k: int, steps: int = 300, l2: float = 1e-3):
        self.k = k
        self.mean = x.mean(0) if len(x) else np.zeros(N_FEATURES)
        self.std = x.std(0) + 1e-6 if len(x) else np.ones(N_FEATURES)
        z = self._wide(x)
        self.w = np.zeros((z.shape[1], k))
        if not len(x):
            return
        hot = np.eye(k)[y]
        v, rate = np.zeros_like(self.w), 0.5
        for _ in range(steps):
            g = z.T @ (self._soft(z @ self.w) - hot) / len(z) + l2 * self.w
            v = 0.9 * v - rate * 0.1 * g
            self.w += v

    def _wide(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -5, 5)
        return np.hstack([z, z * z / 5, np.ones((len(z), 1))])

    @staticmethod
    def _soft(a: np.ndarray) -> np.ndarray:
        e = np.exp(a - a.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        return self._soft(np.einsum("ij,jk->ik", self._wide(x), self.w))  # one row's doesn't depend on its batch


def fit_domains(docs: DataFrame, labels: DataFrame, label: str, k: int, rows: int = TRAIN_ROWS) -> Softmax:
    """From at most `rows` labelled documents; label values are 0 to k - 1."""
    sample = labelled_sample(docs, labels, label, rows).mapInArrow(_features(["y"]), "y int, n long, x array<double>").collect()
    x, y = np.array([r["x"] for r in sample], float).reshape(-1, N_FEATURES), np.array([r["y"] for r in sample], int)
    ok = (y >= 0) & (y < k)
    x, y = x[ok], y[ok]
    order = np.lexsort(np.vstack([x.T[::-1], y])) if len(x) else []
    return Softmax(x[order], y[order], k)


def with_posteriors(docs: DataFrame, model: Softmax, carry: list[str]) -> DataFrame:
    """The columns in `carry`, n (tokens: words between white space) and p (posterior per domain)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            p = shared.value.posteriors(np.array([features(t) for t in texts], float).reshape(-1, N_FEATURES))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carry), pa.array([len((t or "").split()) for t in texts], pa.int64()), flat], [*carry, "n", "p"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    names = list(dict.fromkeys([*carry, "text"]))
    return docs.select(*names).mapInArrow(run, f"{schema}, n long, p array<double>" if carry else "n long, p array<double>")


def rates_of(n: np.ndarray, p: np.ndarray, steps: list[np.ndarray], start: float, pull: float, eta: float) -> np.ndarray:
    """The rates after these steps: from `start`, down the gradient in the tokens' metric, and never below 0."""
    r = np.full(len(n), float(start))
    for g in steps:
        r = np.maximum(0.0, r - eta * (p @ g + pull * (r - start)))
    return np.where(n > 0, r, float(start))


def _columns(b, k):
    return b.column("n").to_numpy().astype(float), b.column("p").flatten().to_numpy().reshape(-1, k)


def _totals(k, state):
    def run(batches):
        steps, start, pull, eta = state.value
        total = np.zeros(k)
        for b in batches:
            n, p = _columns(b, k)
            total += (rates_of(n, p, steps, start, pull, eta) * n) @ p
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], [f"d{i}" for i in range(k)])

    return run


def _with_rates(k, state, names):
    def run(batches):
        for b in batches:
            n, p = _columns(b, k)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(rates_of(n, p, *state.value))], [*names, "rate"])

    return run


def solve_rates(rows: DataFrame, targets: tuple[float, ...], steps: int = STEPS, pull: float = PULL, start: float = 1.0, total: float | None = None, anchor: int | None = None):
    """`rows` (with n and p) with the rate, and the domains' totals before, wanted and after.

    `rows` is read once for each step; a step sends one number per domain from each task. total: expected tokens wanted in all (as many as
    there are). anchor: take the total that lets this domain keep its tokens.
    """
    k, context = len(targets), rows.sparkSession.sparkContext

    def sums(state):
        parts = rows.select("n", "p").mapInArrow(_totals(k, context.broadcast(state)), ", ".join(f"d{i} double" for i in range(k)))
        return np.array([v or 0.0 for v in parts.agg(*(F.sum(f"d{i}") for i in range(k))).first()])

    done: list[np.ndarray] = []
    now = sums((done, start, pull, 1.0))
    weights = np.array(targets) / sum(targets)
    if anchor is not None and weights[anchor] > 0:
        total = now[anchor] / weights[anchor]
    goal = weights * (now.sum() if total is None else total)
    scale = np.maximum(goal, 1e-9 * max(1.0, now.sum()))
    before = now
    # The matrix of second derivatives in the tokens' metric is at most the largest share over target.
    eta = 1.0 / (float(np.max(np.maximum(now, goal) / scale)) + pull)
    for _ in range(steps):
        gap = (now - goal) / scale
        if np.abs(gap).max() < 1e-3:
            break
        done = [*done, gap]
        now = sums((done, start, pull, eta))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    out = rows.mapInArrow(_with_rates(k, context.broadcast((done, start, pull, eta)), rows.columns), f"{schema}, rate double")
    return out, before, goal, now


def _bounded(n, p, b, slopes, start, shift, least, most):
    """Rates after the accumulated steps, projected on their bounds, and which rows are free to move."""
    low = b.column(least).to_numpy() if least else 0.0
    raw = start - sum((p[:, i] - shift[i]) * slopes[i] for i in range(p.shape[1]))  # one row's rate doesn't depend on its batch
    return np.where(n > 0, np.clip(raw, low, most), start), (raw > low) & (raw <= most)


def _moments(k, state):
    def run(batches):
        total, bend = np.zeros(k), np.zeros((k, k))
        for b in batches:
            n, p = _columns(b, k)
            r, free = _bounded(n, p, b, *state.value)
            q = p - state.value[2]
            total += (r * n) @ p
            bend += (q * (n * free)[:, None]).T @ q
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*total, *bend.reshape(-1))], [f"d{i}" for i in range(k + k * k)])

    return run


def _with_met_rates(k, state, names):
    def run(batches):
        for b in batches:
            n, p = _columns(b, k)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(_bounded(n, p, b, *state.value)[0])], [*names, "rate"])

    return run


def meet_targets(rows: DataFrame, targets: tuple[float, ...], pull: float = PULL, start: float = 1.0, total: float | None = None, anchor: int | None = None, shares: bool = False, least: str | None = None, most: float = math.inf):
    """As solve_rates(), but until every domain's total is within TOLERANCE of its target, at any mix.

    Projected gradient steps in their lazy form: the gradient of the squared gap with respect to a row's rate is p . gap, so all steps together are
    one number per domain (slopes), and the rates are start - p . slopes projected on their bounds. The steps are scaled by the k x k matrix of second
    derivatives over the rows that no bound holds, which makes their number independent of the mix. Each step is one aggregate. Where the pull holds the totals off
    their targets it is weakened tenfold, from the point reached. If no rates meet the targets, the least point under the given pull stands, with a
    warning that names the totals.

    shares: targets are shares of whatever total comes out. least: a column of each row's least rate (0 without it). most: the largest rate.
    """
    k, context = len(targets), rows.sparkSession.sparkContext
    weights = np.array(targets) / sum(targets)
    shift = weights if shares else np.zeros(k)
    asked = ["n", "p", *([least] if least else [])]

    def at(slopes):
        parts = rows.select(*asked).mapInArrow(_moments(k, context.broadcast((slopes, start, shift, least, most))), ", ".join(f"d{i} double" for i in range(k + k * k)))
        got = np.array([v or 0.0 for v in parts.agg(*(F.sum(f"d{i}") for i in range(k + k * k))).first()])
        return got[:k], got[k:].reshape(k, k)

    slopes = np.zeros(k)
    now, bend = at(slopes)
    before = now
    if anchor is not None and weights[anchor] > 0:
        total = now[anchor] / weights[anchor]
    wanted = weights * (now.sum() if total is None else total)
    goal = lambda x: weights * x.sum() if shares else wanted
    scale = np.maximum(wanted, 1e-9 * max(1.0, now.sum()))
    off = lambda x: float(np.abs((x - goal(x)) / np.maximum(goal(x), 1e-9 * max(1.0, x.sum()))).max())
    first = None
    while off(now) >= TOLERANCE:
        for _ in range(MOST_STEPS):
            left = (now - goal(now)) / scale - pull * slopes
            if np.abs(left).max() < TOLERANCE / 100:
                break
            step, size = np.linalg.solve(bend / scale[:, None] + pull * np.eye(k), left), 1.0
            while True:  # shorter steps until one brings the point nearer
                there = slopes + size * step
                now_, bend_ = at(there)
                if np.linalg.norm((now_ - goal(now_)) / scale - pull * there) < np.linalg.norm(left) or size < 1e-3:
                    break
                size /= 2
            slopes, now, bend = there, now_, bend_
        first = first or (slopes, now)
        pull /= 10
        if pull < LEAST_PULL:
            break
    if off(now) >= TOLERANCE:
        slopes, now = first
        warnings.warn(f"no rates found that meet the targets: tokens by domain {now.tolist()}, wanted {goal(now).tolist()}", stacklevel=2)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    state = context.broadcast((slopes, start, shift, least, most))
    return rows.mapInArrow(_with_met_rates(k, state, rows.columns), f"{schema}, rate double"), before, goal(now), now


def mix(docs: DataFrame, labels: DataFrame, label: str = "quality", targets=TARGETS, rows: int = TRAIN_ROWS, carry=("doc_id",), stash: Stash | None = None, keep: int | None = None, **how) -> DataFrame:
    """The columns in `carry` (which n, p, least and rate must not clash with), n, p and rate.

    keep: documents whose posterior of this domain is 0.5 or more have a rate of 1 at least: a bound of the solver, not a change of its result.
    """
    taken = {"n", "p", "least", "rate"} & set(carry)
    if taken:
        raise ValueError(f"columns to carry clash with the result's: {sorted(taken)}")
    stash = stash or Stash(docs.sparkSession, "mixing")
    model = fit_domains(docs, labels, label, len(targets), rows)
    known = with_posteriors(docs, model, list(carry))
    if keep is not None:
        known = known.withColumn("least", (F.element_at("p", keep + 1) >= 0.5).cast("double"))
        how = {"least": "least"} | how
    return meet_targets(stash.put(known), targets, **how)[0].drop("least")


def op1_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    out = mix(docs, labels)
    return out.select("doc_id", F.col("n").alias("n_tokens"), *(F.element_at("p", i + 1).alias(f"p_{d}") for i, d in enumerate(DOMAINS)), "rate")


def mix_stage(spark, docs, sf_dir):
    """Pipeline stage: low-quality text is thinned until the domains' expected tokens stand in their target shares.

    Rates lie between 0 and 1, and the solver holds those of clean documents (a posterior of 0.5 or more for high quality) at 1. A document stays if
    a hash of its id (of its text, without an id) is below its rate, so repeated rows stay or go together. Texts that are null or without words have a rate of 1. Where low-quality
    text is below its share already, nothing goes and a warning says so. An empty table gives no rows; long texts count whole; other columns pass through,
    whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    out = mix(packed(docs), labels, carry=("doc_id", "text", "_rest"), keep=1, shares=True, most=1.0)
    u = F.conv(F.substring(F.sha2(F.concat(F.lit("mix|"), F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit(""))), 256), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    return unpacked(out.filter(u < F.col("rate")), docs.columns)
