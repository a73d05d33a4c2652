"""Token counts without token ids.

Pieces are counted once per distinct pre-token, joined to per-document pre-token frequencies, and summed.
Frequent pre-tokens (a table of at most HEAD rows, so with a fixed bound) are broadcast with their counts, so
a common word never gathers rows in one task; all others meet their counts in a shuffle join on the pre-token.
Which of the two ways a pre-token takes changes no result.

Rows are kept as they are: a null text counts as empty, repeated rows and ids are counted row by row, a null id
stays, and columns with clashing names pass through unread.
"""

from __future__ import annotations

import math
from collections import Counter

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.pretokens import shared
from millrace.session import Stash

#: Rows of the broadcast table (about 2 MB); its pre-tokens have 9 in 10 of all frequencies in Zipf-like text.
HEAD = 100_000
#: Distinct pre-tokens that a task holds before it hands on its partial counts.
HOLD = 200_000


def _vocabulary(path):
    def run(batches):
        tok, seen = shared(path), Counter()
        flush = lambda: pa.RecordBatch.from_pydict({"piece": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
        for b in batches:
            for text in b.column(0).to_pylist():
                if text and tok.plain(text):
                    seen.update(tok.split(text))
                    if len(seen) > HOLD:
                        yield flush()
                        seen.clear()
        yield flush()

    return run


def _piece_counts(path):
    def run(batches):
        tok = shared(path)
        for b in batches:
            pieces = b.column("piece").to_pylist()
            yield pa.RecordBatch.from_pydict({"piece": b.column("piece"), "k": pa.array([len(x) // 4 for x in tok.encode_pieces(pieces)], pa.int32())})

    return run


def _frequencies(path, head):
    """Per row: bytes, the tokens of head pre-tokens and of texts that go through the library whole, and the frequencies of the rest."""

    def run(batches):
        tok, known = shared(path), head.value
        for b in batches:
            size, done, rest = [], [], []
            for text in b.column("text").to_pylist():
                size.append(len((text or "").encode()))
                if not text:
                    done.append(0), rest.append([])
                elif not tok.plain(text):
                    done.append(len(tok.whole(text))), rest.append([])
                else:
                    total, tail = 0, []
                    for p, n in tok.counts(text).items():
                        k = known.get(p)
                        if k is None:
                            tail.append((p, n))
                        else:
                            total += k * n
                    done.append(total), rest.append(tail)
            tails = pa.array([[{"piece": p, "n": n} for p, n in r] for r in rest], pa.list_(pa.struct([("piece", pa.string()), ("n", pa.int32())])))
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "n_bytes": pa.array(size, pa.int64()), "done": pa.array(done, pa.int64()), "tail": tails})

    return run


def _least(pieces: DataFrame, head: int) -> int:
    """The least frequency that at most `head` pre-tokens reach, to an eighth of a power of two."""
    step = F.floor(F.log2("n") * 8).cast("int")
    bins = {r["b"]: r["count"] for r in pieces.groupBy(step.alias("b")).count().collect()}
    room, least = head, max(bins, default=0) + 1
    for b in sorted(bins, reverse=True):
        room -= bins[b]
        if room < 0:
            break
        least = b
    return max(1, math.ceil(2 ** (least / 8) - 1e-9))


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, head: int = HEAD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit."""
    spark = docs.sparkSession
    stash = Stash(spark, "token-counts")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Every distinct pre-token with its frequency and, once for each, its number of pieces.
    seen = docs.select("text").mapInArrow(_vocabulary(tokenizer), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = stash.put(seen)
    counted = pieces.select("piece").mapInArrow(_piece_counts(tokenizer), "piece string, k int")
    top = pieces.filter(F.col("n") >= _least(pieces, head)).select("piece").collect()
    tok = shared(tokenizer)
    words = [r[0] for r in top]
    known = spark.sparkContext.broadcast(dict(zip(words, (len(x) // 4 for x in tok.encode_pieces(words)), strict=True)))
    rows = stash.put(docs.mapInArrow(_frequencies(tokenizer, known), "doc_id long, n_bytes long, done long, tail array<struct<piece string, n int>>").withColumn("row", F.monotonically_increasing_id()))
    tail = rows.select("row", F.explode("tail").alias("t")).select("row", "t.piece", "t.n")
    sums = tail.join(counted, "piece").groupBy("row").agg(F.sum(F.col("n").cast("long") * F.col("k")).alias("more"))
    out = rows.select("row", "doc_id", "n_bytes", "done").join(sums, "row", "left")
    n = F.col("done") + F.coalesce("more", F.lit(0))
    return out.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))


def op10_token_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
