"""Small models shared by operators of this subpackage; all are trained on bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id"):
    """Rows that no model is fitted on: every fifth id by its crc32. Null for null ids."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, where=None, seed: str = "sample") -> DataFrame:
    """At most `rows` labelled documents (doc_id, text, y), the first in the order of a hash of doc_id.

    Labels that are null, and ids that are null, are no training rows. Where an id has several labels, the
    largest holds; where several documents have the id, all are used, or none if they don't fit any more. The sample has a fixed bound, so its ids are broadcast.
    """
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if where is not None:
        ids = ids.filter(where)
    ids = ids.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    order = F.sha2(F.concat(F.lit(f"{seed}|"), F.col("doc_id").cast("string")), 256)
    chosen = [(r["doc_id"], r["y"]) for r in ids.orderBy(order, "doc_id").limit(rows).collect()]
    schema = f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, y int"
    spark = docs.sparkSession
    known = spark.createDataFrame(chosen, schema)
    held = {r["doc_id"]: r["count"] for r in docs.select("doc_id").join(F.broadcast(known), "doc_id").groupBy("doc_id").count().collect()}  # a row an id at most
    room, fit = rows, []
    for i, y in chosen:
        n = held.get(i, 0)
        if 0 < n <= room:
            room -= n
            fit.append((i, y))
    return docs.select("doc_id", "text").join(F.broadcast(spark.createDataFrame(fit, schema)), "doc_id")


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights (the last one is the bias) by Newton steps; with one class only, the bias alone speaks."""
    x = np.hstack([x, np.ones((len(x), 1))]) if len(x) else np.zeros((0, x.shape[1] + 1))
    w = np.zeros(x.shape[1])
    if not len(x):
        w[-1] = -4.0
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(x) + l2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(x) + l2 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
