"""Packing of documents into sequences of a fixed number of tokens, over the histogram of piece lengths.

A document is its token ids and an end id. It is cut into pieces of at most `size` ids; the histogram of
piece lengths has at most `size` bins whatever the corpus, so the plan is made on the driver: lengths are
placed longest first, each piece into the pack that is shortest at that moment, in groups of equal packs (a pattern and a
count). Patterns are joined back to the pieces by the rank of a piece among those of its length. The rank is
counted in two steps (within a salted part of the length, plus the sizes of the parts before), so one length
that holds most pieces is still dealt over many tasks.

Null texts are empty documents (the end id alone). Repeated rows and ids, and null ids, are documents of their
own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.pretokens import shared
from millrace.session import Stash, partitions

SIZE = 2048
END_ID = 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cut(path, size, end_id):
    def run(batches):
        tok, end = shared(path), end_id.to_bytes(4, "little")
        for b in batches:
            rows = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), tok.column(b.column("text")), strict=True):
                raw = raw.tobytes() + end
                ids = len(raw) // 4
                for at in range(0, ids, size):
                    n = min(size, ids - at)
                    for k, v in zip(rows, (doc_id, at, n, zlib.crc32(raw[4 * at : 4 * (at + n)]), ids), strict=True):
                        rows[k].append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in rows.items()})

    return run


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """(count, [(length, copies), ...]) per pattern: lengths longest first, each piece into the pack that is shortest at that moment.

    A heap holds groups of equal packs by what they hold. The shortest group takes one piece a pack, and of a group larger than what
    is left, the rest stays as it is; then the next shortest is looked for. Where no pack can take a length, packs are opened that hold as many
    copies of it as fit: a new pack is the shortest one until it is full. Packs of equal content are one group.
    """
    done: list[tuple[int, tuple]] = []
    heap: list[tuple[int, int, int, tuple]] = []  # tokens so far, order of making, packs, linked pattern
    made = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and heap and heap[0][0] + length <= size:
            held, _, packs, pattern = heapq.heappop(heap)
            take = min(packs, left)
            if take < packs:
                made += 1
                heapq.heappush(heap, (held, made, packs - take, pattern))
            left -= take
            made += 1
            chain = (pattern[0], length, pattern[2] + 1) if pattern[1] == length else (pattern, length, 1)
            heapq.heappush(heap, (held + length, made, take, chain))
        if left:
            fit = size // length
            for packs, each in ((left // fit, fit), (1 if left % fit else 0, left % fit)):
                if packs:
                    made += 1
                    heapq.heappush(heap, (each * length, made, packs, (None, length, each)))
        while heap and heap[0][0] == size:
            _, _, packs, pattern = heapq.heappop(heap)
            done.append((packs, pattern))
    done += [(packs, pattern) for _, _, packs, pattern in sorted(heap)]
    out = []
    for packs, pattern in done:
        chain = []
        while pattern:
            pattern, length, each = pattern
            chain.append((length, each))
        out.append((packs, chain[::-1]))
    return out


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, tuple[list[int], list[int], list[int], list[int]]]:
    """Per length, runs of ranks: first rank, first sequence, copies in a sequence, offset of the first copy."""
    out: dict[int, tuple[list[int], list[int], list[int], list[int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for packs, chain in patterns:
        offset = 0
        for length, each in chain:
            runs = out.setdefault(length, ([], [], [], []))
            for to, v in zip(runs, (used.get(length, 0), base, each, offset), strict=True):
                to.append(v)
            used[length] = used.get(length, 0) + packs * each
            offset += length * each
        base += packs
    return out


def _place(table):
    def run(batches):
        runs = {k: tuple(np.array(x) for x in v) for k, v in table.value.items()}
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, off = np.zeros(len(length), "i8"), np.zeros(len(length), "i8")
            for n in np.unique(length):
                at = length == n
                first, base, each, start = runs[int(n)]
                r = rank[at]
                k = np.searchsorted(first, r, side="right") - 1
                i = r - first[k]
                seq[at], off[at] = base[k] + i // each[k], start[k] + i % each[k] * n
            cols = {c: b.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
            yield pa.RecordBatch.from_pydict(cols | {"sequence_id": pa.array(seq), "offset": pa.array(off)})

    return run


def ranked(pieces: DataFrame, salts: int) -> DataFrame:
    """Adds `rank`, from 0, of each row among those of its length."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "row"), F.lit(salts)))
    parts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "row")
    inner = salted.withColumn("at", F.row_number().over(within) - 1)
    return inner.join(parts, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("at")).drop("salt", "base", "at")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    stash = Stash(spark, "packing")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = stash.put(source.mapInArrow(_cut(tokenizer, size, end_id), PIECES).withColumn("row", F.monotonically_increasing_id()))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `size` rows
    table = spark.sparkContext.broadcast(places(plan(histogram, size)))
    out = ranked(pieces, partitions(spark)).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
    return out.mapInArrow(_place(table), f"{PIECES}, sequence_id long, offset long")


def op9_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
