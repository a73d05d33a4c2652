"""Line dedup by a segment-partition edit join.

A line of at least MIN_CHARS code points goes where an equal line stands earlier, or where a line whose first occurrence is
earlier lies within EDITS edits of it. Order: doc_id (nulls last, then by a hash of the text), then line number.

Of two lines within k edits, the shorter's k + 1 segments hold one that the longer has whole, at a position close to
the segment's own. So each distinct line is an entry under its segments (with length and place), and a probe for the
substrings of its own that segments of lines as long, or up to k shorter, could equal. Entries and probes are dealt out
by their key's hash, packed in binary rows; a key with both makes a bucket. Members of a bucket meet in blocks, are
sifted by letter counts where there are many, and are verified with a banded bit-parallel edit distance on the whole lines. A bucket larger than a block is
judged within its blocks first, which leaves few lines of a group of near copies; those that are left then meet the whole bucket. Only lines to be
dropped leave a bucket, never pairs.

Shorter lines stay, and so do null texts. Rows that repeat a doc_id are one document, and keep the same lines: repeated rows stay
equal. Without a doc_id each text is a document. Texts and lines of any length count whole. An empty table gives no rows. Columns with clashing names pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import packed, unpacked
from millrace.llm.components import HOT, join_salted
from millrace.session import Stash, partitions

EDITS, MIN_CHARS = 2, 20
BLOCK = 512
#: Bits of the bounded filter of lines that a bucket holds. A full filter lets more lines pass and changes no result.
FILTER_BITS = 1 << 26
#: Bytes that a line's entries and probes take (about), and those of a part that a task holds.
LINE_BYTES, PART_BYTES = 200, 64 << 20


def segments(n: int, k: int) -> list[tuple[int, int]]:
    """(position, length) of the k + 1 segments of a line of n characters; the last ones are longer by one."""
    base, more = divmod(n, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        size = base + (i >= k + 1 - more)
        out.append((at, size))
        at += size
    return out


def probes(n: int, k: int) -> list[tuple[int, int, int, int]]:
    """(entry length, segment, position, length) of the substrings of a line of n characters that can equal a segment."""
    out = []
    for shorter in range(k + 1):
        length = n - shorter
        if length < k + 1:
            continue
        for i, (at, size) in enumerate(segments(length, k)):
            # With i errors at most before the segment, or k - i behind it, one segment at least matches so.
            low = max(at - i, at + shorter - (k - i), 0)
            high = min(at + i, at + shorter + (k - i), n - size)
            out += [(length, i, p, size) for p in range(low, high + 1)]
    return out


def within(a: str, b: str, k: int) -> bool:
    """Is the edit distance of a and b at most k? One machine word of 2k + 1 diagonals, a step for each character of b."""
    if abs(len(a) - len(b)) > k:
        return False
    if a == b:
        return True
    lo, top = 0, min(len(a), len(b))
    while lo < top and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < top - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    if not a or not b:
        return len(a) + len(b) <= k
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    # Bit t of column j is row j - k + t; vp, vn: where the value rises or falls from the row above.
    mask = (1 << (2 * k + 1)) - 1
    top_bit = 1 << (2 * k)
    vp, vn = mask & ~((1 << (k + 1)) - 1), 0
    end = 1 << (len(a) - len(b) + k)
    score = max(0, len(a) - len(b))
    for j, c in enumerate(b, 1):
        vp, vn = vp >> 1 | top_bit, vn >> 1
        shift = j - k - 1
        hit = where.get(c, 0)
        hit = (hit >> shift if shift >= 0 else hit << -shift) & mask
        d0 = ((((hit & vp) + vp) ^ vp) | hit | vn) & mask
        hp = (vn | ~(d0 | vp)) & mask
        hn = d0 & vp
        if not d0 & end:
            score += 1
            if score > k:
                return False
        hp = (hp << 1) & mask
        vp, vn = ((hn << 1) | ~(d0 | hp)) & mask, d0 & hp
    return score <= k


def line_hash(line: str) -> int:
    """Spark's xxhash64 of a string."""
    return xxhash.xxh64_intdigest(line.encode(), 42)


def _split(edits, least, parts):
    """Packed rows (part, entries, probes): arrays of key and line hash. A line that a task has seen is not packed again."""

    def run(batches):
        shapes: dict[int, tuple] = {}
        seen: dict[int, int] = {}
        keys, lines = ([], []), ([], [])

        def flush():
            out = {"part": [], "entries": [], "probes": []}
            packed = []
            for ks, hs in zip(keys, lines, strict=True):
                k, h = np.array(ks, np.uint64), np.array(hs, np.uint64)
                part = (k % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                packed.append((k[order], h[order], cuts))
                ks.clear(), hs.clear()
            for p in range(parts):
                blobs = []
                for k, h, cuts in packed:
                    k, h = k[cuts[p] : cuts[p + 1]], h[cuts[p] : cuts[p + 1]]
                    # Five bytes of the key's quotient: with the part, as good as the whole key.
                    low = (k // np.uint64(parts)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                    blobs.append(low.tobytes() + h.astype("<u8").tobytes())
                if blobs[0] or blobs[1]:
                    for c, v in zip(out.values(), (p, *blobs), strict=True):
                        c.append(v)
            return pa.RecordBatch.from_pydict({"part": pa.array(out["part"], pa.int32()), "entries": pa.array(out["entries"], pa.binary()), "probes": pa.array(out["probes"], pa.binary())})

        for b in batches:
            for text in b.column(0).to_pylist():
                for line in (text or "").split("\n"):
                    n = len(line)
                    if n < least:
                        continue
                    h = line_hash(line)
                    if seen.get(h) == (other := hash(line)):  # 128 bits together
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen[h] = other
                    shape = shapes.get(n)
                    if shape is None:
                        if len(shapes) > 20_000:
                            shapes.clear()
                        shape = shapes[n] = ([(n * 8 + i, p, p + s) for i, (p, s) in enumerate(segments(n, edits))], [(m * 8 + i, p, p + s) for m, i, p, s in probes(n, edits) if m >= least])
                    for to, at, cuts in zip(keys, lines, shape, strict=True):
                        to += [xxhash.xxh3_64_intdigest(line[p:q], seed) for seed, p, q in cuts]
                        at += [h] * len(cuts)
                if len(keys[1]) > 400_000:
                    yield flush()
        yield flush()

    return run


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    keys, lines = [], []
    for b in blobs:
        n = len(b) // 13
        k = np.zeros((n, 8), np.uint8)
        k[:, :5] = np.frombuffer(b, np.uint8, 5 * n).reshape(n, 5)
        keys.append(k.view("<u8").reshape(-1))
        lines.append(np.frombuffer(b, "<u8", n, 5 * n))
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(keys), np.concatenate(lines)) if keys else (empty, empty)


def _buckets(batches):
    """Members of the keys that have an entry and a probe of different lines: bucket, line, kind (1 entry, 2 probe, 3 both), n. Rows come part by part."""

    def members(p, entries, probes):
        (ek, eh), (pk, ph) = _unpack(entries), _unpack(probes)
        both = np.intersect1d(ek, pk)
        e, q = np.isin(ek, both), np.isin(pk, both)
        key, line = np.concatenate([ek[e], pk[q]]), np.concatenate([eh[e], ph[q]])
        kind = np.concatenate([np.ones(int(e.sum()), np.int32), np.full(int(q.sum()), 2, np.int32)])
        if not len(key):
            return
        order = np.lexsort((kind, line, key))
        key, line, kind = key[order], line[order], kind[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
        at = np.flatnonzero(new)
        kind = np.bitwise_or.reduceat(kind, at)
        key, line = key[at], line[at]
        group = np.ones(len(key), bool)
        group[1:] = key[1:] != key[:-1]
        n = np.diff(np.append(np.flatnonzero(group), len(key)))
        n = np.repeat(n, n)
        keep = n > 1
        bucket = key[keep] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(p)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(bucket.astype(np.int64)), "h": pa.array(line[keep].astype(np.int64)), "kind": pa.array(kind[keep]), "n": pa.array(n[keep].astype(np.int32))})

    part, entries, probes_ = None, [], []
    for b in batches:
        for p, e, q in zip(b.column("part").to_pylist(), b.column("entries").to_pylist(), b.column("probes").to_pylist(), strict=True):
            if p != part:
                if part is not None:
                    yield from members(part, entries, probes_)
                part, entries, probes_ = p, [], []
            entries.append(e), probes_.append(q)
    if part is not None:
        yield from members(part, entries, probes_)


def bounded_filter(rows: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """Bits of the values' low digits, as many as 16 for each value up to `bits`; 1/64 as many rows reach the driver at most."""
    n = rows.count()
    size = 1 << min(bits.bit_length() - 1, max(10, (16 * n).bit_length()))
    word = F.shiftrightunsigned(F.col(column).bitwiseAND(F.lit(size - 1)), 6)
    words = rows.groupBy(word.alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 as int))")).alias("m")).toPandas()
    out = np.zeros(size // 64, np.int64)
    out[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64)
    return out.view(np.uint64)


def _wanted(least, held):
    def run(batches):
        words = held.value
        top = len(words) * 64 - 1
        for b in batches:
            out = {"none": [], "did": [], "pos": [], "h": [], "text": []}
            for none, did, text in zip(b.column("none").to_pylist(), b.column("did").to_pylist(), b.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                lines = text.split("\n")
                own = [i for i, x in enumerate(lines) if len(x) >= least]
                h = np.array([line_hash(lines[i]) for i in own], np.uint64)
                low = h & np.uint64(top)
                hit = np.flatnonzero(words[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1))
                for x in hit:
                    for c, v in zip(out.values(), (none, did, own[x], int(h[x].astype(np.int64)), lines[own[x]]), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_pydict({"none": pa.array(out["none"], pa.bool_()), "did": pa.array(out["did"], pa.int64()), "pos": pa.array(out["pos"], pa.int32()), "h": pa.array(out["h"], pa.int64()), "text": pa.array(out["text"], pa.string())})

    return run


def _letters(lines: list[str]) -> np.ndarray:
    out = np.zeros((len(lines), 64), np.int32)
    for i, x in enumerate(lines):
        out[i] = np.bincount(np.frombuffer(x.encode("utf-32-le"), "<u4") & 63, minlength=64)
    return out


def _drops(edits):
    """Keys of the lines that have an earlier line within `edits`. Rows sorted by bucket and block.

    role 0: all rows of a block against each other. Role 1 (lines that are asked about) against role 2 (the whole bucket's): later ones of role 1 go.
    """

    def near(rows):
        # rows: role, kind, key, order, text
        gone = set()

        def pair(r, s):
            if r[2] == s[2] or (r[0] and r[0] == s[0]):
                return
            later = r if r[3] > s[3] else s
            if later[0] != 2 and later[2] not in gone and within(r[4], s[4], edits):
                gone.add(later[2])

        def judge(entries, asks):
            if len(entries) * len(asks) <= 400:
                for r in entries:
                    for s in asks:
                        if 0 <= len(s[4]) - len(r[4]) <= edits:
                            pair(r, s)
                return
            a, b = _letters([r[4] for r in entries]), _letters([s[4] for s in asks])
            na, nb = a.sum(1), b.sum(1)
            for i in range(len(a)):
                maybe = np.flatnonzero((nb - na[i] >= 0) & (nb - na[i] <= edits))
                if len(maybe):
                    maybe = maybe[np.abs(b[maybe] - a[i]).sum(1) <= 2 * edits]
                for x in maybe:
                    pair(entries[i], asks[x])

        role = lambda x, kind: [r for r in rows if r[0] == x and r[1] & kind]
        for x, y in ((0, 0), (1, 2), (2, 1)):
            entries, asks = role(x, 1), role(y, 2)
            if entries and asks:
                judge(entries, asks)
        return gone

    def run(batches):
        group, rows = None, []
        for b in batches:
            out = []
            for bucket, role, kind, key, none, did, pos, text, lo, hi in zip(*(b.column(n).to_pylist() for n in ("bucket", "role", "kind", "key", "none", "did", "pos", "text", "lo", "hi")), strict=True):
                if (bucket, lo, hi) != group:
                    if rows:
                        out += near(rows)
                    group, rows = (bucket, lo, hi), []
                rows.append((role, kind, key, (none, did, pos, key), text))  # repeated ids share places; the key parts them
            yield pa.RecordBatch.from_pydict({"key": pa.array(out, pa.binary())})
        if rows:
            yield pa.RecordBatch.from_pydict({"key": pa.array(list(near(rows)), pa.binary())})

    return run


def _cleaned(least, names):
    def run(batches):
        for b in batches:
            texts, lines_, gone_ = [], [], []
            for text, drops in zip(b.column("text").to_pylist(), b.column("_drops").to_pylist(), strict=True):
                lines = [] if text is None else text.split("\n")
                gone = []
                if drops:
                    gone = sorted({d["pos"] for d in drops if d["pos"] < len(lines) and len(lines[d["pos"]]) >= least and line_hash(lines[d["pos"]]) == d["h"] & (2**64 - 1)})
                    out = set(gone)
                    text = "\n".join(x for i, x in enumerate(lines) if i not in out) if gone else text
                texts.append(text), lines_.append(len(lines)), gone_.append(gone)
            cols = {n: pa.array(texts, pa.string()) if n == "text" else b.column(n) for n in names}
            yield pa.RecordBatch.from_pydict(cols | {"_n_lines": pa.array(lines_, pa.int64()), "_gone": pa.array(gone_, pa.list_(pa.int32()))})

    return run


def _identity():
    """Columns that name a document: whether its id is null, and the id (without one, a hash of the text)."""
    return [F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("did")]


def dropped_lines(docs: DataFrame, stash: Stash, edits: int = EDITS, least: int = MIN_CHARS) -> DataFrame:
    """(none, did, _drops): line numbers to drop, with the lines' hashes, of each document that has any."""
    spark = docs.sparkSession
    source = docs.select(*_identity(), "text")
    lines = source.select("none", "did", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter(F.length("line") >= least)
    lines = lines.select("none", "did", "pos", F.unhex(F.md5("line")).alias("key"), F.xxhash64("line").alias("h"))
    firsts = stash.put(lines.groupBy("key").agg(F.min(F.struct("none", "did", "pos")).alias("first"), F.count("*").alias("n")))
    total = firsts.agg(F.sum("n")).first()[0] or 0
    tasks = partitions(spark)
    parts = max(4 * tasks, -(-total * LINE_BYTES // PART_BYTES))
    packed_ = source.select("text").mapInArrow(_split(edits, least, parts), "part int, entries binary, probes binary")
    dealt = packed_.repartitionById(tasks, F.col("part") % tasks).sortWithinPartitions("part")
    members = stash.put(dealt.mapInArrow(_buckets, "bucket long, h long, kind int, n int"))
    held = spark.sparkContext.broadcast(bounded_filter(members.select("h").distinct(), "h"))
    texts = source.mapInArrow(_wanted(least, held), "none boolean, did long, pos int, h long, text string").withColumn("key", F.unhex(F.md5("text")))
    # By the first occurrence's place, so that a common line doesn't gather at its key.
    texts = texts.join(firsts.select("key", "first.*"), ["key", "none", "did", "pos"])
    texts = stash.put(texts.dropDuplicates(["key", "none", "did", "pos"]))

    def judged(rows):
        meet = rows.join(texts, "h").repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "key")
        return stash.put(meet.select("bucket", "role", "kind", "key", "none", "did", "pos", "text", "lo", "hi").mapInArrow(_drops(edits), "key binary").distinct())

    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK)).cast("int")
    block = lambda n: F.pmod(F.xxhash64("h"), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    near = judged(members.select("bucket", "h", "kind", F.lit(0).alias("role"), block("n").alias("lo"), F.lit(0).alias("hi")))
    large = members.filter(F.col("n") > BLOCK)
    if not large.isEmpty():
        left = large.join(texts.join(near, "key", "left_anti").select("h").distinct(), "h")
        asked = stash.put(left.join(left.groupBy("bucket").agg(F.count("*").cast("int").alias("m")), "bucket"))
        asks = asked.select("bucket", "h", "kind", F.lit(1).alias("role"), block("m").alias("lo"), every("n").alias("hi"))
        rest = large.join(asked.select("bucket", "m").distinct(), "bucket")
        rest = rest.select("bucket", "h", "kind", F.lit(2).alias("role"), every("m").alias("lo"), "n").select("bucket", "h", "kind", "role", "lo", block("n").alias("hi"))
        near = stash.put(near.unionByName(judged(asks.unionByName(rest))).distinct())
    bad = stash.put(firsts.join(near.withColumn("near", F.lit(True)), "key", "left").filter("n > 1 or near"))
    hot = bad.filter(F.col("n") * HOT > total).select("key")
    out = join_salted(lines, bad.select("key", "first", "near"), "key", hot, ["did", "pos"])
    again = ~((F.col("none") == F.col("first.none")) & (F.col("did") == F.col("first.did")) & (F.col("pos") == F.col("first.pos")))
    return out.filter(F.coalesce("near", F.lit(False)) | again).groupBy("none", "did").agg(F.collect_set(F.struct("pos", "h")).alias("_drops"))


def _dedup(docs: DataFrame, edits: int, least: int) -> DataFrame:
    """packed() rows without their dropped lines, with _n_lines and _gone."""
    drops = dropped_lines(docs, Stash(docs.sparkSession, "line-dedup"), edits, least)
    both = docs.select("*", *_identity()).join(drops, ["none", "did"], "left").drop("none", "did")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return both.mapInArrow(_cleaned(least, docs.columns), f"{schema}, _n_lines long, _gone array<int>")


def dedup_lines(docs: DataFrame, edits: int = EDITS, least: int = MIN_CHARS) -> DataFrame:
    """`docs` with the lines dropped from `text`, and _n_lines (before) and _gone (the numbers of dropped lines), in place of columns of these names."""
    columns = [c for c in docs.columns if c not in ("_n_lines", "_gone")]
    out = _dedup(packed(docs), edits, least)
    rest = [F.col(c) if c in ("doc_id", "text") else F.col("_rest").getField(c).alias(c) for c in columns]
    return out.select(*rest, "_n_lines", "_gone")


def op5_line_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.size("_gone").cast("long").alias("n_dropped"), F.col("_gone").alias("dropped"), F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


def dedup_lines_stage(spark, docs, sf_dir):
    """Pipeline stage: texts lose their repeated lines. A document that had words and has none left goes: all it said stands elsewhere.

    Null and empty texts stay. Other columns pass through, whatever their names, but n_chars, which is counted anew. The module says what null ids, repeated rows and
    long texts mean; an empty table gives no rows.
    """
    out = _dedup(packed(docs), EDITS, MIN_CHARS)
    blank = F.regexp_replace("text", r"(?U)\s+", "") == ""
    kept = unpacked(out.filter((F.size("_gone") == 0) | ~blank), docs.columns)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept
