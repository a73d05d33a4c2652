"""Matching: bags, sorted pairs, adaptive modes, reconciliation, bag overlap."""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import floor_ratio
from millrace.operators.order import running
from millrace.session import Stash


def _known(keys: list[str], side: str) -> Column:
    """Null keys meet nothing: they stay apart by side."""
    none = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    return F.when(none, F.col(side)).alias("_apart")


def _sides(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides, each in a struct of its own (l or r)."""
    struct = lambda df, name: F.struct(*df.columns).alias(name)
    a, b = left.select(*keys, struct(left, "l")), right.select(*keys, struct(right, "r"))
    return a.withColumn("r", F.lit(None).cast(b.schema["r"].dataType)).unionByName(b.withColumn("l", F.lit(None).cast(a.schema["l"].dataType)))


def _paired(both: DataFrame, keys: list[str], order: list[Column], equal: bool) -> DataFrame:
    """Pairs by place: rows are dealt by their keys once, and numbered, counted and paired there."""
    rows = both.repartition(*keys).withColumn("_left", F.col("l").isNotNull())
    rows = rows.withColumn("rn", F.row_number().over(Window.partitionBy(*keys, "_left").orderBy(*order)))
    if equal:
        n = lambda c: F.count(F.when(c, 1)).over(Window.partitionBy(*keys))
        rows = rows.withColumns({"_nl": n(F.col("_left")), "_nr": n(~F.col("_left"))}).filter("_nl = _nr")
    one = lambda c: F.first(c, ignorenulls=True).alias(c)
    return rows.groupBy(*keys, "rn", _known(keys, "_left")).agg(one("l"), one("r")).select(*keys, "rn", "l", "r")


def bag_match(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[str], right_order: list[str], how: str = "full") -> DataFrame:
    """Pairs rows of equal keys one to one, in each side's order; every right row is used once at most. how: full, left or inner.

    Columns: keys, rn, l (struct of the left row), r (struct of the right row). A side without a partner is null.
    """
    order = [F.col(f"{s}.{c}").asc_nulls_last() for s, cs in (("l", left_order), ("r", right_order)) for c in cs]
    out = _paired(_sides(left, right, keys), keys, order, False)
    return out if how == "full" else out.filter("l is not null" if how == "left" else "l is not null and r is not null")


def sorted_pairs(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """Optimal one-dimensional assignment: in groups of equal size on both sides, the i-th smallest meets the i-th smallest."""
    order = [F.col(f"{s}.{c}").asc_nulls_last() for s, cs in (("l", left_order), ("r", right_order)) for c in cs]
    return _paired(_sides(left, right, keys), keys, order, True).filter("l is not null and r is not null")


def sorted_pairs_within(df: DataFrame, keys: list[str], is_left: Column, order: list[str]) -> DataFrame:
    """sorted_pairs() of two parts of one table, in one scan; rows where `is_left` is null take no part."""
    row = F.struct(*df.columns)
    both = df.filter(is_left.isNotNull()).select(*keys, F.when(is_left, row).alias("l"), F.when(~is_left, row).alias("r"))
    by = [F.coalesce(F.col(f"l.{c}"), F.col(f"r.{c}")).asc_nulls_last() for c in order]
    return _paired(both, keys, by, True).filter("l is not null and r is not null")


def match_counts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: expected, found, matched (the smaller), missing and extra. Counts meet, rows don't."""
    tag = lambda df, is_left: df.select(*keys, F.lit(is_left).alias("_left"))
    return counts_within(tag(left, True).unionByName(tag(right, False)), keys, F.col("_left"))


def counts_within(df: DataFrame, keys: list[str], is_left: Column) -> DataFrame:
    """match_counts() of two parts of one table: one aggregate. Null keys stay apart by side."""
    n = lambda c: F.count(F.when(c, 1))
    rows = df.select(*keys, is_left.alias("_left"))
    both = rows.groupBy(*keys, _known(keys, "_left")).agg(n(F.col("_left")).alias("expected"), n(~F.col("_left")).alias("found")).drop("_apart")
    matched = F.when(F.col("expected") < F.col("found"), F.col("expected")).otherwise(F.col("found"))
    return both.withColumns({"matched": matched, "missing": F.col("expected") - matched, "extra": F.col("found") - matched})


def adaptive_mode(hits: Column, left_ids: Column, right_ids: Column, names_matched: Column, expected: Column, found: Column, id_rate: float = 0.5, count_rate: float = 0.98) -> Column:
    """id where half of the ids are found, else name; count where names fail though nearly all parts are there; none without parts."""
    by_id = (left_ids > 0) & (hits >= id_rate * F.least(left_ids, F.greatest(F.lit(1), right_ids)))
    lost = (names_matched < count_rate * F.least(expected, found)) & (found >= count_rate * expected)
    return F.when(by_id, "id").when((expected == 0) | (found == 0), "none").when(lost, "count").otherwise("name")


def reconcile(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of both sides with status: both, only_left, only_right. Null keys stay apart by side."""
    tag = lambda df, is_left: df.select(*keys, F.lit(is_left).alias("_left"))
    both = tag(left, True).unionByName(tag(right, False)).withColumn("_apart", _known(keys, "_left"))
    return reconcile_within(both, [*keys, "_apart"], F.col("_left")).drop("_apart")


def reconcile_within(df: DataFrame, keys: list[str], is_left: Column) -> DataFrame:
    """reconcile() of two parts of one table: one aggregate with two flags."""
    found = df.filter(is_left.isNotNull()).groupBy(*keys).agg(F.bool_or(is_left).alias("_l"), F.bool_or(~is_left).alias("_r"))
    status = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "only_left").otherwise("only_right")
    return found.select(*keys, status.alias("status"))


def bag_overlap(queries: DataFrame, rows: DataFrame, query_id: str, row_id: str, items: str, least: float = 0.0, block: int = 1_000_000) -> DataFrame:
    """Multiset overlap of each query bag with each row's bag (arrays of strings): shared, overlap (by the smaller bag) and jaccard, where overlap is at least `least`.

    The queries are a stated set that meets all rows: they are broadcast as an inverted index, in blocks of at most `block` distinct items in all (a bag of
    more is a block of its own), each a pass over the rows. All items count, however frequent; nothing is shuffled, and rows meet a query only through items they share.
    """
    spark = rows.sparkSession
    bags = queries.select(F.col(query_id).alias("q"), F.explode(items).alias("i")).groupBy("q", "i").agg(F.count("*").alias("n"))
    sizes = bags.groupBy("q").agg(F.count("*").alias("d"))
    where = Stash(spark, "overlap").put(running(sizes, [], [F.col("q")], F.col("d"), "upto").select("q", F.floor((F.col("upto") - F.col("d")) / block).cast("long").alias("block")))
    kinds = f"q {queries.schema[query_id].dataType.simpleString()}, id {rows.schema[row_id].dataType.simpleString()}, shared long, nq long, nr long"
    source, found = rows.select(F.col(row_id).alias("id"), F.col(items).alias("items")), None
    for (number,) in sorted(tuple(r) for r in where.select("block").distinct().collect()):  # one for each `block` items of the queries
        index: dict[str, list] = {}
        names: dict = {}
        total: list[int] = []
        for q, i, n in bags.join(where.filter(F.col("block") == number).select("q"), "q").select("q", "i", "n").collect():
            at = names.setdefault(q, len(names))
            if at == len(total):
                total.append(0)
            total[at] += n
            to = index.setdefault(i, ([], []))
            to[0].append(at), to[1].append(n)
        held = spark.sparkContext.broadcast((list(names), np.array(total), {i: (np.array(a), np.array(n)) for i, (a, n) in index.items()}))
        part = source.mapInArrow(_overlaps(held, least), kinds)
        found = part if found is None else found.unionByName(part)
    found = spark.createDataFrame([], kinds) if found is None else found
    overlap, union = F.col("shared") / F.least("nq", "nr"), F.col("nq") + F.col("nr") - F.col("shared")
    return found.select(F.col("q").alias(query_id), F.col("id").alias(row_id), "shared", F.round(overlap, 4).alias("overlap"), F.round(F.col("shared") / union, 4).alias("jaccard"))


def _overlaps(held, least):
    def run(batches):
        names, total, index = held.value
        for b in batches:
            out = {c: [] for c in ("q", "id", "shared", "nq", "nr")}
            for row, items in zip(b.column("id").to_pylist(), b.column("items").to_pylist(), strict=True):
                bag, shared = Counter(items or ()), np.zeros(len(names), np.int64)
                for i, n in bag.items():
                    if i in index:
                        at, counts = index[i]
                        shared[at] += np.minimum(counts, n)
                size = bag.total()
                for k in np.flatnonzero((shared > 0) & (shared >= least * np.minimum(total, size))):
                    for c, v in zip(out.values(), (names[k], row, int(shared[k]), int(total[k]), size), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_pydict({"q": pa.array(out["q"]), "id": pa.array(out["id"], b.schema.field("id").type), **{c: pa.array(out[c], pa.int64()) for c in ("shared", "nq", "nr")}} if out["q"] else {"q": pa.array([], pa.int64()), "id": pa.array([], b.schema.field("id").type), **{c: pa.array([], pa.int64()) for c in ("shared", "nq", "nr")}})

    return run


def coverage(counts: DataFrame, by: list[str]) -> DataFrame:
    """Expected, matched and the coverage rounded down, for each group of match_counts()."""
    out = counts.groupBy(*by).agg(F.sum("expected").alias("expected"), F.sum("matched").alias("matched"))
    return out.withColumn("coverage", floor_ratio(F.col("matched"), F.col("expected")))
