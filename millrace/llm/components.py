"""Connected components of an edge table, groups dealt in blocks, joins with hot keys, and a bounded filter before a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import Stash, partitions


#: Rows of a narrow table for a task, about, and tasks that even a small one is dealt to.
TASK_ROWS, LEAST_TASKS = 100_000, 8


def few(df: DataFrame, rows: int) -> DataFrame:
    """A shuffled table of so many narrow rows in tasks of a fair size, where there are many more shuffle partitions than that."""
    return df.coalesce(max(LEAST_TASKS, min(partitions(df.sparkSession), -(-rows // TASK_ROWS))))


def _least(pairs: DataFrame, rows: int) -> DataFrame:
    """Adds m, the least of a and its neighbours b. An aggregate and a join, so a node with many neighbours can be split."""
    m = few(pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), rows)
    return few(pairs.join(m, "a"), rows)


def components(edges: DataFrame, stash: Stash, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of `edges` (a, b long); the root is the least node of its component.

    Alternating large-star and small-star steps, each written to the shared folder; ends when a round changes nothing.
    """
    now = stash.put(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    seen = mark(now)
    for _ in range(rounds):
        n = 2 * seen[0]
        if not n:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _least(both, n).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = few(large.filter("a <> b").distinct(), n)
        small = _least(large, n)
        nxt = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        nxt = stash.put(few(nxt, n))
        now_mark = mark(nxt)
        stash.drop(now)
        now = nxt
        if now_mark == seen:
            break
        seen = now_mark
    else:
        raise RuntimeError("components did not settle")
    out = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return out.unionByName(out.select(F.col("root").alias("node"), "root").distinct())


def in_blocks(rows: DataFrame, group: str, member: str, n: str, size: int) -> DataFrame:
    """Deals each group into pairs of blocks: adds lo, hi and own, the row's block.

    A group of up to `size` rows is one block with itself. In a larger one each pair of blocks is a task's work
    of its own, so every two members meet in exactly one place and no task holds more than two blocks.
    """
    blocks = F.ceil(F.col(n) / F.lit(size)).cast("int")
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    rows = rows.withColumn("own", own)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other")


#: A key is hot with more than one row in so many: there are at most so many hot keys, whatever the table.
HOT = 1000


def join_salted(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, spread, how: str = "inner", salts: int = 64) -> DataFrame:
    """left.join(right, key, how), with the left rows of hot keys (at most HOT, so broadcast) dealt to several tasks by the columns in `spread`.

    The right side has few rows a key; those of hot keys are repeated for each salt.
    """
    mark = F.broadcast(hot.select(F.col(key).alias("_k")).withColumn("_hot", F.lit(True)))
    a = left.join(mark, F.col(key) == F.col("_k"), "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0).cast("long"))).drop("_hot", "_k")
    each = F.when(F.col("_hot"), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    b = right.join(mark, F.col(key) == F.col("_k"), "left").withColumn("_salt", F.explode(each)).drop("_hot", "_k")
    return a.join(b, [key, "_salt"], how).drop("_salt")


#: Bits of a filter before a join, at most: half a million rows of 64 are broadcast. A full filter lets more rows pass and changes no result.
FILTER_BITS = 1 << 25


def sieved(left: DataFrame, right: DataFrame, keys: list[str], bits: int | None = None) -> DataFrame:
    """The rows of `left` that can have a partner in `right`: all that have one, and a few others. 16 bits for each row of `right`, up to `bits`."""
    size = 1 << min((bits or FILTER_BITS).bit_length() - 1, max(10, (16 * right.count()).bit_length()))
    at = F.xxhash64(*keys).bitwiseAND(F.lit(size - 1))
    bit = F.expr("cast(_at & 63 as int)")
    words = right.select(at.alias("_at")).groupBy(F.shiftrightunsigned("_at", 6).alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    marked = left.withColumn("_at", at)
    meets = (F.shiftrightunsigned("_at", 6) == F.col("_word")) & (F.call_function("shiftrightunsigned", F.col("_bits"), bit).bitwiseAND(F.lit(1).cast("long")) == 1)
    return marked.join(F.broadcast(words), meets, "left_semi").drop("_at")
