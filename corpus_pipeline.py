"""The corpus pipeline: toxicity, line dedup, near-dedup, mixing and packing, each over all that the stage before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.line_dedup import dedup_lines_stage
from millrace.llm.mixing import mix_stage
from millrace.llm.near_dedup import drop_near_duplicates
from millrace.llm.packing import pack_documents
from millrace.llm.toxicity import drop_toxic
from millrace.session import Stash


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents with their places in sequences.

    A null text is an empty document; repeated rows, equal and null ids are documents of their own; a long text is cut into several pieces. An empty table gives no rows. Other columns, whatever
    their names, are not read.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines_stage),
    ("near-dedup", drop_near_duplicates),
    ("mixing", mix_stage),
    ("packing", pack),
]

#: Models, edit distance and tokenizers are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written and read again, and goes when the next one is written."""
    stash = Stash(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs, before = stash.put(stage(spark, docs, sf_dir)), docs
        stash.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
