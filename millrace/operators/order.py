"""Places, running sums and even slices in the order of a group, without a task that gets a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(df: DataFrame, by: list[str], order: list[Column], weight: Column, name: str = "upto", total: str | None = None) -> DataFrame:
    """Adds the sum of `weight` over the rows of the group up to and with each row (`name`) and, if asked for, over the whole group (`total`).

    With no `by`, over all rows. `order` must leave no ties. No task gets a whole group: ranges of (by, order) are written to the shared folder, as
    ranges drawn anew may differ; then sums of ranges, their running sums, and running sums within each range.
    """
    from millrace.session import Stash, partitions

    stash = Stash(df.sparkSession, "ranked")
    rows = stash.put(df.withColumn("_weight", weight).repartitionByRange(partitions(df.sparkSession), *by, *order).withColumn("_range", F.spark_partition_id()))
    sums = rows.groupBy("_range", *by).agg(F.sum("_weight").alias("_n"))
    group = Window.partitionBy(*by)  # a group has one row per range that it reaches
    upto = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    keys = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    base = sums.select(F.col("_range").alias("_of"), *keys, F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_base"), F.sum("_n").over(group).alias("_all"))
    own = F.sum("_weight").over(Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    cond = F.col("_range") == F.col("_of")
    for i, c in enumerate(by):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    out = rows.withColumn("_own", own).join(base, cond).withColumn(name, F.col("_base") + F.col("_own"))
    return out.select(*df.columns, name, *([F.col("_all").alias(total)] if total else []))


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str = "rank", total: str | None = None) -> DataFrame:
    """Each row's place (from 1) in the order of its group and, if asked for, the group's size."""
    return running(df, by, order, F.lit(1).cast("long"), name, total)


def slices(df: DataFrame, by: list[str], order: list[Column], n: int, name: str = "tile") -> DataFrame:
    """n slices of each group as even as can be (1 to n), in order; larger ones first."""
    rows = ranked(df, by, order, "_at", "_all")
    at, big, small = F.col("_at") - 1, F.col("_all") % n, F.floor(F.col("_all") / n)
    edge = big * (small + 1)
    tile = F.when(at < edge, F.floor(at / (small + 1))).otherwise(big + F.floor((at - edge) / F.greatest(F.lit(1), small)))
    return rows.withColumn(name, (tile + 1).cast("int")).select(*df.columns, name)
