"""Text: rule classes, redaction and its checks, counts of patterns and tokens."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns of personal data (no look-around, so that any engine can run them).
EMAIL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9]"
PHONE = r"\+?[0-9][0-9()-]{0,15}[ -][0-9][0-9 ()-]{5,24}[0-9]"


def mask(text: Column, patterns: dict[str, str]) -> Column:
    """Each pattern's finds replaced by [NAME], in order."""
    for name, p in patterns.items():
        text = F.regexp_replace(text, p, f"[{name}]")
    return text


def redact_values(text: Column, values: Column, least: int = 4, mark: str = "[X]") -> Column:
    """Literal values of at least `least` characters replaced, the longest first."""
    longest = F.array_sort(F.filter(F.array_distinct(values), lambda v: F.length(v) >= least), lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    return F.aggregate(longest, text, lambda t, v: F.replace(t, v, F.lit(mark)))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def removed_tokens(df: DataFrame, ident: str, before: Column, after: Column) -> DataFrame:
    """Per row, the tokens of `before` that `after` lacks as bags: how many (n_removed) and how many different ones (n_words); rows that lose none are left out.

    The difference lies within a row, so nothing is shuffled: both bags go to a batch function.
    """

    def run(batches):
        for b in batches:
            rows = {"id": [], "n_removed": [], "n_words": []}
            for i, x, y in zip(b.column("id").to_pylist(), b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
                lost = Counter(x or ())
                lost.subtract(Counter(y or ()))
                n = [k for k in lost.values() if k > 0]
                if n:
                    rows["id"].append(i), rows["n_removed"].append(sum(n)), rows["n_words"].append(len(n))
            yield pa.RecordBatch.from_pydict({"id": pa.array(rows["id"], b.schema.field("id").type), "n_removed": pa.array(rows["n_removed"], pa.int64()), "n_words": pa.array(rows["n_words"], pa.int64())})

    kind = df.schema[ident].dataType.simpleString()
    out = df.select(F.col(ident).alias("id"), before.alias("a"), after.alias("b")).mapInArrow(run, f"id {kind}, n_removed long, n_words long")
    return out.withColumnRenamed("id", ident)


def record_blocks(lines: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Records of an indented text: a line that isn't indented starts one, indented lines are its attributes."""
    from millrace.operators.sample import blocks

    return blocks(lines, by, [order], ~F.rlike(F.col(value), F.lit(r"^\s")))


def bracketed(lines: DataFrame, by: list[str], order: str, value: str, begin: str, end: str) -> DataFrame:
    """Keeps the lines strictly between a `begin` line and the next `end` line."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    v = F.trim(F.col(value))
    mark = F.when(v == begin, F.lit(True)).when(v == end, F.lit(False))
    return lines.withColumn("_in", F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit(False))).filter(F.col("_in") & (v != begin)).drop("_in")
