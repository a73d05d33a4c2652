"""Token ids in packed binary rows: best-fit decreasing with a segment tree over free capacities.

A document (its ids and an end id) that is longer than a row is split without loss; every id lies in exactly
one row. Each task packs windows of a bounded number of tokens by itself: pieces by falling length, each into the
open row whose free capacity fits best, found in a segment tree over capacities. Rows with room left at a window's end stay open for the
next one, up to a fixed number. No shuffle, and memory that depends on the window alone.

A packed row has its ids as little-endian numbers padded to `size`, the cumulative lengths of its segments
(starting with 0), the offsets at which positions begin anew at 0, and doc_id and start of each segment. write_shards() puts rows into
binary files of a bounded number of rows under a folder that all executors share, with a manifest; read_shards() gives the rows of such files. The query writes, and
returns what it reads back.

Null texts are empty documents (the end id alone); repeated rows and ids, and null ids, are documents of their own; a text of any length is split
without loss. An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import uuid
import zlib
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.pretokens import shared
from millrace.session import Stash, partitions

SIZE = 2048
END_ID = 1
PAD_ID = 0
#: Tokens that a task holds before it packs them.
WINDOW = 1 << 21
#: Rows that stay open from one window to the next.
OPEN = 256
#: Rows of a binary file at most.
FILE_ROWS = 8192

SCHEMA = "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, starts array<long>, doc_tokens array<long>"


class Capacities:
    """Open rows by free capacity; a segment tree of counts finds the least capacity of at least n."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        self._change(free, 1)

    def _change(self, at: int, by: int) -> None:
        at += self.leaves
        while at:
            self.tree[at] += by
            at >>= 1

    def take(self, n: int) -> tuple[int, int] | None:
        """Removes and returns (free capacity, row) of the best fit, or None."""
        tree, at = self.tree, n + self.leaves
        if not tree[at]:
            while at > 1 and not (at % 2 == 0 and tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at *= 2
                if not tree[at]:
                    at += 1
        free = at - self.leaves
        self._change(free, -1)
        return free, self.rows[free].pop()


def best_fit_decreasing(lengths: list[int], size: int, free: list[int] = ()) -> list[list[int]]:
    """Per row the indexes it takes; the first rows are those given by their free capacities."""
    rows: list[list[int]] = [[] for _ in free]
    tree = Capacities(size)
    for row, n in enumerate(free):
        tree.add(n, row)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        got = tree.take(n)
        if got is None:
            got = size, len(rows)
            rows.append([])
        rows[got[1]].append(i)
        if got[0] > n:
            tree.add(got[0] - n, got[1])
    return rows


def _pack(path, size, end_id, pad_id, window, dtype):
    def run(batches):
        tok, part = shared(path), TaskContext.get().partitionId()
        top = max(tok.lib.get_vocab_size(with_added_tokens=True) - 1, end_id, pad_id)
        if top > np.iinfo(dtype).max:
            raise ValueError(f"ids of up to {top} don't fit {dtype}")
        made, held, pieces, opened = 0, 0, [], []  # pieces: (doc_id, start, ids, doc_tokens); opened: rows of pieces

        def rows_of(packs):
            nonlocal made
            cols = {k: [] for k in ("sequence_id", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "starts", "doc_tokens")}
            pad = np.full(size, pad_id, dtype).tobytes()
            for pack in packs:
                cu = [0, *accumulate(len(p[2]) for p in pack)]
                row = b"".join([p[2].data for p in pack])
                row += pad[len(row) :]
                for k, v in zip(cols, ((part << 33) + made, cu[-1], row, cu, cu[:-1], [p[0] for p in pack], [p[1] for p in pack], [p[3] for p in pack]), strict=True):
                    cols[k].append(v)
                made += 1
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(cols.items(), kinds, strict=True)})

        def packed(last):
            nonlocal opened, pieces, held
            free = [size - sum(len(p[2]) for p in pack) for pack in opened]
            rows = best_fit_decreasing([len(p[2]) for p in pieces], size, free)
            packs = [(opened[i] if i < len(opened) else []) + [pieces[j] for j in row] for i, row in enumerate(rows)]
            room = sorted(range(len(packs)), key=lambda i: (sum(len(p[2]) for p in packs[i]), i))
            keep = set() if last else {i for i in room[:OPEN] if sum(len(p[2]) for p in packs[i]) < size}
            opened, pieces, held = [packs[i] for i in sorted(keep)], [], 0
            out = [p for i, p in enumerate(packs) if i not in keep]
            for at in range(0, len(out), 512):
                yield rows_of(out[at : at + 512])

        for b in batches:
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), tok.column(b.column("text")), strict=True):
                ids = np.empty(len(raw) + 1, dtype)
                ids[:-1], ids[-1] = raw, end_id
                for at in range(0, len(ids), size):
                    pieces.append((doc_id, at, ids[at : at + size], len(ids)))
                held += len(ids)
                if held >= window:
                    yield from packed(False)
        if pieces or opened:
            yield from packed(True)

    return run


def pack_ids(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, pad_id: int = PAD_ID, window: int = WINDOW, dtype: str = "<u2", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per packed sequence (SCHEMA). dtype: `<u2` for vocabularies up to 65,536 ids, else `<u4`."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(_pack(tokenizer, size, end_id, pad_id, window, dtype), SCHEMA)


MANIFEST = "name string, first long, n_rows long, n_tokens long, n_segments long, ids_crc32 long"


def _write(url, file_rows):
    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(url)
        store.create_dir(root, recursive=True)
        kinds, made, open_ = ("ids", "cu", "pos", "docs"), [], None

        def end():
            nonlocal open_
            outs, row = open_
            for o in outs:
                o.close()
            open_ = None
            return pa.RecordBatch.from_pydict({k: pa.array([v], pa.string() if k == "name" else pa.int64()) for k, v in row.items()})

        try:
            for b in batches:
                cols = [b.column(c).to_pylist() for c in ("sequence_id", "ids", "cu_seqlens", "n_tokens", "doc_ids", "starts", "doc_tokens")]
                for seq, ids, cu, n, doc_ids, starts, totals in zip(*cols, strict=True):
                    if open_ is None:
                        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex[:12]}"
                        made.append(name)
                        open_ = [store.open_output_stream(f"{root}/{name}.{k}.bin") for k in kinds], {"name": name, "first": seq, "n_rows": 0, "n_tokens": 0, "n_segments": 0, "ids_crc32": 0}
                    outs, row = open_
                    outs[0].write(ids)
                    outs[1].write(np.array([len(cu), *cu], "<i4").tobytes())
                    outs[2].write(np.array([len(cu) - 1, *cu[:-1]], "<i4").tobytes())
                    outs[3].write(np.array([(i is not None, i or 0, s, t) for i, s, t in zip(doc_ids, starts, totals, strict=True)], "<i8").tobytes())
                    row["ids_crc32"] = zlib.crc32(ids, row["ids_crc32"])
                    for k, v in (("n_rows", 1), ("n_tokens", n), ("n_segments", len(doc_ids))):
                        row[k] += v
                    if row["n_rows"] >= file_rows:
                        yield end()
            if open_:
                yield end()
        except Exception:
            for o in open_[0] if open_ else ():
                o.close()
            for name in made:
                for k in kinds:
                    store.delete_file(f"{root}/{name}.{k}.bin")
            raise

    return run


def write_shards(packed: DataFrame, url: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """Writes each task's rows as binary files under `url` (any pyarrow filesystem that all executors share) and returns the manifest.

    `<name>.ids.bin`: the id matrix, row after row; `<name>.cu.bin`: int32 cumulative lengths, each row's count
    first; `<name>.pos.bin`: int32 offsets in the row at which positions begin anew at 0, their count first; `<name>.docs.bin`: four int64 a segment (1, or 0 for a null id; doc_id; start; the
    document's tokens). A task that fails takes its files away; one that is run again, or lost with its executor, leaves or writes other names;
    only names in the manifest count. So write the manifest out once, and read that.
    """
    return packed.mapInArrow(_write(url, file_rows), MANIFEST)


def pack_shards(docs: DataFrame, tokenizer: str, url: str, file_rows: int = FILE_ROWS, size: int = SIZE, end_id: int = END_ID, pad_id: int = PAD_ID, window: int = WINDOW, dtype: str = "<u2", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """write_shards(pack_ids(...)) in one function: rows go to the files from where they are packed."""
    pack, write = _pack(tokenizer, size, end_id, pad_id, window, dtype), _write(url, file_rows)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(lambda batches: write(pack(batches)), MANIFEST)


def read_shards(manifest: DataFrame, url: str, size: int = SIZE, dtype: str = "<u2") -> DataFrame:
    """The packed rows (SCHEMA) of the files that a manifest names. A file whose ids are not those that were written is an error."""

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(url)

        def load(name, kind, dtype):
            with store.open_input_stream(f"{root}/{name}.{kind}.bin") as f:
                return np.frombuffer(f.read(), dtype)

        wide = size * np.dtype(dtype).itemsize
        for b in batches:
            for name, first, n_rows, crc in zip(*(b.column(c).to_pylist() for c in ("name", "first", "n_rows", "ids_crc32")), strict=True):
                raw, cu, docs = load(name, "ids", np.uint8), load(name, "cu", "<i4"), load(name, "docs", "<i8").reshape(-1, 4)
                if len(raw) != n_rows * wide or zlib.crc32(raw) != crc:
                    raise ValueError(f"{name}.ids.bin is not what the manifest says")
                ends, at = [], 0
                for _ in range(n_rows):
                    ends.append((at + 1, at + 1 + int(cu[at])))
                    at = ends[-1][1]
                seg = np.concatenate([[0], np.cumsum([y - x - 1 for x, y in ends])])
                ids_of = pa.array(np.where(docs[:, 0] == 1, docs[:, 1], 0), pa.int64(), mask=docs[:, 0] == 0)
                for lo in range(0, n_rows, 512):
                    to = min(lo + 512, n_rows)
                    part, off = slice(int(seg[lo]), int(seg[to])), pa.array(seg[lo : to + 1] - seg[lo], pa.int32())
                    cus = np.concatenate([cu[x:y] for x, y in ends[lo:to]])
                    resets = np.concatenate([cu[x : y - 1] for x, y in ends[lo:to]])
                    cut = pa.array(seg[lo : to + 1] - seg[lo] + np.arange(to - lo + 1), pa.int32())
                    listed = lambda v: pa.ListArray.from_arrays(off, v)  # noqa: B023, E731
                    cols = {
                        "sequence_id": pa.array(first + np.arange(lo, to), pa.int64()),
                        "n_tokens": pa.array([int(cu[y - 1]) for _, y in ends[lo:to]], pa.int32()),
                        "ids": pa.array([raw[i * wide : (i + 1) * wide].tobytes() for i in range(lo, to)], pa.binary()),
                        "cu_seqlens": pa.ListArray.from_arrays(cut, pa.array(cus, pa.int32())),
                        "position_resets": listed(pa.array(resets, pa.int32())),
                        "doc_ids": listed(ids_of[part.start : part.stop]),
                        "starts": listed(pa.array(docs[part, 2])),
                        "doc_tokens": listed(pa.array(docs[part, 3])),
                    }
                    yield pa.RecordBatch.from_pydict(cols)

    return manifest.select("name", "first", "n_rows", "ids_crc32").mapInArrow(run, SCHEMA)


def op4_token_output(spark, sf_dir):
    """Writes the binary files below the shared folder, and gives the rows that they hold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stash = Stash(spark, "token-output")
    url = f"{stash.base}/files"
    manifest = stash.put(pack_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), url))
    files = manifest.count()
    return read_shards(manifest.repartition(max(1, min(files, 4 * partitions(spark)))), url)
