"""Keeps a table's other columns out of the way while an operator works on doc_id and text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one struct, so that none clashes with a name an operator adds."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*rest) if rest else F.lit(None).cast("int")).alias("_rest"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the table that packed() took, in their order."""
    return df.select(*(F.col(c) if c in ("doc_id", "text") else F.col("_rest").getField(c).alias(c) for c in columns))
