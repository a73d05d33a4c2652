"""Greedy set cover of a bag by several sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import Stash


def greedy_cover(want: DataFrame, offers: DataFrame, key: str, source: str, least: float = 0.01) -> DataFrame:
    """(rank, source, gain, coverage): sources in the order in which they are chosen, each the one with the largest gain (ties: the least name) while that is above `least`.

    Coverage is the share of the wanted bag (rows of `want`) that the chosen sources' bags hold together. A round is an aggregate over counts in the shared folder, and as each adds
    more than `least`, there are fewer than 1 / least rounds.
    """
    if not 0 < least < 1:
        raise ValueError("least must lie between 0 and 1")
    spark = want.sparkSession
    stash = Stash(spark, "cover")
    need = stash.put(want.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("need")).withColumn("held", F.lit(0).cast("long")))
    total = need.agg(F.sum("need")).first()[0] or 0
    counts = stash.put(offers.join(need.select(key), key, "left_semi").groupBy(source, key).agg(F.count("*").alias("n")))
    chosen, covered = [], 0
    while total:
        more = F.least(F.col("need"), F.col("held") + F.col("n")) - F.least("need", "held")
        gains = counts.join(need, key).groupBy(source).agg(F.sum(more).alias("gain"))
        best = gains.filter(~F.col(source).isin([c[1] for c in chosen])).orderBy(F.desc("gain"), source).first()
        if best is None or best["gain"] / total <= least:
            break
        covered += best["gain"]
        chosen.append((len(chosen) + 1, best[source], best["gain"] / total, covered / total))
        mine = counts.filter(F.col(source) == best[source]).select(key, "n")
        need = stash.put(need.join(mine, key, "left").select(key, "need", (F.col("held") + F.coalesce("n", F.lit(0))).alias("held")))
    kind = offers.schema[source].dataType.simpleString()
    return spark.createDataFrame(chosen, f"rank int, `{source}` {kind}, gain double, coverage double")
