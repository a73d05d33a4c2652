"""MinHash near-dedup with dart-thrown signatures.

Every shingle owns the quarter plane weight x rank, on which darts lie as a Poisson process of unit density,
drawn from hashes of the shingle and of a cell; cells double in size, so the darts below (weight, rank) come from few
of them. A text's darts are those within its shingles' weights and below a rank that makes their expected number about
K ln K + 2K; each dart falls on one of K coordinates, and the earliest on a coordinate is its value. Two texts agree on a
coordinate with the probability of their weighted Jaccard similarity. Where a coordinate stays empty the rank limit doubles.

A shingle's weight is the number of its occurrences in the text, so the similarity is that of bags of shingles (with weighted=False, of sets).

Coordinates are banded for candidates, and each link is verified on whole texts, exactly. Copies of a text are one node. In a band's bucket every member is
verified against the least one, the bucket's centre, which also gives its distance to the centre. One minus the similarity is a metric: two members can only
be similar if their distances to the centre differ by no more than 1 - SIMILARITY. So of the members that still lie in different components, only those that have
another component's member at such a distance are compared pair by pair, in blocks; the many copies around a centre and a stranger far from it never meet.
Each two texts that share a band and are similar end in one class.

Texts that are null or without words are in a class of their own row (class_id is their doc_id). Texts of fewer words than a shingle
are one shingle. A class id is the least doc_id of its documents; null ids stay rows, and a class of nulls alone has a null id. Repeated rows
are copies; texts at exactly SIMILARITY are linked. A text of any length counts whole. An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import packed, unpacked
from millrace.llm.components import HOT, components, few, in_blocks, join_salted, sieved
from millrace.session import Stash

WIDTH, SIMILARITY = 5, 0.8
#: 20 bands of 3: a pair at similarity 0.8 shares no band with probability 6e-7.
BANDS, ROWS = 20, 3
#: Shingles, and members, of a bucket that meet in one block, about; members that meet a copy of their centre's text; steps of a distance's histogram.
BLOCK, MEMBERS, FAN, STEPS = 400_000, 512, 2048, 4
#: Bins of a text's shingles by hash, a power of two: they rule out pairs without their sets.
SIEVE = 128

#: Darts, about, that are thrown at once: short texts take as many as long ones. Words, and keys, that a task remembers; rows that it takes from Arrow at once.
CHUNK, KNOWN, SLICE = 300_000, 100_000, 500

_ONE = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(float) * 2.0**-53


_POISSON: dict[int, np.ndarray] = {}


def _poisson(rho: int) -> np.ndarray:
    """Distribution function of a Poisson number of mean 2 ** rho."""
    if rho not in _POISSON:
        mean = 2.0**rho
        top = int(mean + 12 * math.sqrt(mean) + 20)
        logs = [k * math.log(mean) - mean - math.lgamma(k + 1) for k in range(top)]
        _POISSON[rho] = np.cumsum(np.exp(logs))
    return _POISSON[rho]


def _darts(h, w, doc, limit):
    """(doc, rank, dart) of the darts within the weights `w` of elements `h` and below limit[doc]."""
    out = []
    top = limit[doc]
    nu = 0
    while len(h) and 2.0**nu - 1 < w.max():
        heavy = w > 2.0**nu - 1
        rho = 0
        while True:
            low = (2.0**rho - 1) / 2.0**nu
            at = np.flatnonzero(heavy & (top > low))
            if not len(at):
                break
            seed = mix(h[at] ^ np.uint64((nu << 8 | rho) * 0x2545F4914F6CDD1D & (2**64 - 1)))
            n = np.searchsorted(_poisson(rho), unit(seed), side="right")
            e = np.repeat(at, n)
            j = np.arange(len(e)) - np.repeat(np.cumsum(n) - n, n)
            dart = mix(np.repeat(seed, n) + (j.astype(np.uint64) + _ONE) * np.uint64(0xD1342543DE82EF95))
            weight = 2.0**nu - 1 + unit(mix(dart ^ np.uint64(0x5851F42D4C957F2D))) * 2.0**nu
            rank = low + unit(mix(dart ^ np.uint64(0x14057B7EF767814F))) * 2.0 ** (rho - nu)
            ok = (weight <= w[e]) & (rank <= top[e])
            out.append((doc[e[ok]], rank[ok], dart[ok]))
            rho += 1
        nu += 1
    if not out:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def dart_signatures(h: np.ndarray, w: np.ndarray, doc: np.ndarray, n: int, k: int) -> np.ndarray:
    """n x k values. h: 64-bit elements, w: positive weights, doc: owner of each, 0 to n - 1, each with an element at least."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(doc, weights=w, minlength=n)
    darts = k * math.log(k) + 2 * k
    todo = np.arange(n)
    while len(todo):
        limit = np.zeros(n)
        limit[todo] = darts / total[todo]
        mine = limit[doc] > 0
        d, rank, dart = _darts(h[mine], w[mine], doc[mine], limit)
        slot = d * k + (mix(dart ^ np.uint64(0x9FB21C651E98DF25)) % np.uint64(k)).astype(np.int64)
        order = np.lexsort((rank, slot))
        slot, dart = slot[order], dart[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        full = np.bincount(slot[first] // k, minlength=n) == k
        good = full[slot // k] & first
        out.reshape(-1)[slot[good]] = dart[good]
        todo = todo[~full[todo]]
        darts *= 2
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), (len(sig), bands)).copy()
    for r in range(rows):
        key = mix(key ^ sig[:, r::rows][:, :bands])
    return key.astype(np.int64)


class Shingles:
    """Hashed shingles of many texts at once."""

    def __init__(self, width: int = WIDTH):
        self.width, self.order, self.hash = width, {}, np.zeros(1 << 16, np.uint64)

    def of(self, texts: list[list[str]], weighted: bool = False):
        """(element, weight, text) of the distinct shingles of word lists that have a word."""
        order = self.order
        if len(order) > KNOWN:
            order.clear()
        ids, known, fresh = [], len(order), []
        for words in texts:
            for x in set(words).difference(order):
                order[x] = len(order)
                fresh.append(xxhash.xxh3_64_intdigest(x))
            ids.extend(map(order.__getitem__, words))
        if len(order) > len(self.hash):
            self.hash = np.append(self.hash, np.zeros(max(len(order), 2 * len(self.hash)) - len(self.hash), np.uint64))
        self.hash[known : len(order)] = fresh
        size = np.array([len(x) for x in texts])
        doc = np.repeat(np.arange(len(texts)), size)
        x = self.hash[np.array(ids, np.int64)]
        # A window starts at each word with width - 1 more behind it in its text; a shorter text is one window.
        at = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size)
        start = np.flatnonzero((at <= np.repeat(size, size) - self.width) | ((at == 0) & (np.repeat(size, size) < self.width)))
        left = np.repeat(size, size)[start]
        key = np.full(len(start), 0x27D4EB2F165667C5, np.uint64)
        for i in range(self.width):
            on = np.minimum(start + i, len(x) - 1)
            key = np.where(i < left, mix(key ^ x[on]), key)
        d = doc[start]
        by = np.lexsort((key, d))
        key, d = key[by], d[by]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (d[1:] != d[:-1])
        w = np.diff(np.append(np.flatnonzero(new), len(key))).astype(float) if weighted else np.ones(int(new.sum()))
        return key[new], w, d[new]


def _slices(batches):
    """Arrow batches in parts of SLICE rows, as Python's values take many times the bytes of a batch."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            yield b.slice(at, SLICE)


def _sign(bands, rows, width, weighted):
    """Key, bands and number of shingles; of copies that a task meets, the first."""

    def run(batches):
        made, seen = Shingles(width), set()
        for b in _slices(batches):
            fresh = []
            for i, k in enumerate(b.column("key").to_pylist()):
                if k not in seen:
                    seen.add(k), fresh.append(i)
            if len(seen) > KNOWN:
                seen.clear()
            b = b.take(pa.array(fresh, pa.int64()))
            keys, texts = b.column("key").to_pylist(), b.column("text").to_pylist()
            at = 0
            while at < len(texts):
                part, size, to = [], 0, at
                while to < len(texts) and (size < CHUNK or to == at):
                    part.append(texts[to].split())
                    size += 3 * len(part[-1]) + 5 * bands * rows * int(math.log(bands * rows) + 2)
                    to += 1
                own = [i for i, words in enumerate(part) if words]
                if own:
                    h, w, d = made.of([part[i] for i in own], weighted)
                    got = band_keys(dart_signatures(h, w, d, len(own), bands * rows), bands, rows)
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, got.size + 1, bands), pa.int32()), pa.array(got.reshape(-1)))
                    total = np.bincount(d, weights=w, minlength=len(own)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([keys[at + i] for i in own], pa.binary()), flat, pa.array(total)], ["key", "bands", "size"])
                at = to

    return run


def shingle_set(text: str, width: int = WIDTH, weighted: bool = True) -> frozenset:
    """A text's shingles; with weights, the further occurrences of one are elements of their own, so that a bag's similarity is this set's."""
    words = text.split()
    if len(words) < width:
        return frozenset([tuple(words)])
    grams = list(zip(*(words[i:] for i in range(width)), strict=False))
    out = frozenset(grams)
    if weighted and len(out) < len(grams):
        out |= {(g, i) for g, n in Counter(grams).items() for i in range(1, n)}
    return out


def similar(a: frozenset, b: frozenset, least: float) -> bool:
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(a & b)
    return both >= least * (len(a) + len(b) - both)


def shingle_ids(texts: list[str], width: int = WIDTH, weighted: bool = True) -> list[np.ndarray]:
    """What shingle_set() has of each text, as numbers that are equal in these texts where its elements are: exact, and some bytes a shingle."""
    order: dict[str, int] = {}
    each = []
    for t in texts:
        words = t.split()
        # Shorter texts are one shingle; 0 is no word's number.
        each.append(np.array([order.setdefault(w, len(order) + 1) for w in words] + [0] * (width - len(words)), np.int64))
    x, size = np.concatenate(each), np.array([len(w) for w in each])
    doc, n = np.repeat(np.arange(len(texts)), size), len(order) + 1
    at = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size)
    start = np.flatnonzero(at <= np.repeat(size, size) - width)
    key, doc, top = x[start], doc[start], n
    for i in range(1, width):
        if top * n >= 2**62:  # rank what has been joined so far
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max()) + 1
        key = key * n + x[start + i]
        top *= n
    key = np.unique(key, return_inverse=True)[1]
    by = np.lexsort((key, doc))
    key, doc = key[by], doc[by]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
    if weighted:
        again = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        key = np.unique(key * (int(again.max()) + 1) + again, return_inverse=True)[1]
    else:
        key, doc = key[first], doc[first]
    return np.split(key.astype(np.int32), np.cumsum(np.bincount(doc, minlength=len(texts)))[:-1])


def _verify(width, least, weighted):
    """Of each pair, whether it is similar, and its distance."""

    def run(batches):
        centres: dict[int, frozenset] = {}
        for b in _slices(batches):
            near, apart = [], []
            for x, tx, ty in zip(*(b.column(n).to_pylist() for n in ("a", "ta", "tb")), strict=True):
                mine = centres.get(x)
                if mine is None:
                    if len(centres) > 7:
                        centres.clear()
                    mine = centres[x] = shingle_set(tx, width, weighted)
                its = shingle_set(ty, width, weighted)
                both = len(mine & its)
                union = len(mine) + len(its) - both
                near.append(both >= least * union), apart.append(1 - both / union)
            yield pa.RecordBatch.from_pydict({"a": b.column("a"), "b": b.column("b"), "near": pa.array(near, pa.bool_()), "apart": pa.array(apart, pa.float64())})

    return run


def _compare(width, least, weighted):
    """Rows sorted by band and pair of blocks. Emits links between components; a group's components are united as it goes."""

    def links(band, rows):
        # rows: own, root, node, text, apart, bands, lo, hi. Only members of different components meet, and in the first bucket that they share: another
        # bucket that leaves one of them out has shown by distances that they are not similar.
        up = {r[1]: r[1] for r in rows}

        def find(x):
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        same, reach = rows[0][6] == rows[0][7], 1 - least + 1e-9
        sets = shingle_ids([r[3] for r in rows], width, weighted)
        size = np.array([len(x) for x in sets])
        order = np.lexsort((np.array([r[2] for r in rows]), size))
        sets, size = [sets[i] for i in order], size[order]
        mine = np.zeros(1 + max(int(x.max()) for x in sets), bool)
        own, root = (np.array([rows[i][k] for i in order]) for k in (0, 1))
        apart, keys = np.array([rows[i][4] for i in order]), np.array([rows[i][5] for i in order])
        here = int(np.flatnonzero(keys[0] == band)[0])
        # What two texts share is at most what their counts by a number's low bits share.
        bins = np.stack([np.bincount(x & SIEVE - 1, minlength=SIEVE) for x in sets]).astype(np.int32)
        for i in range(len(sets) - 1):
            at = np.arange(i + 1, np.searchsorted(size, size[i] / least + 1e-6, side="right"))
            at = at[(root[at] != root[i]) & (np.abs(apart[at] - apart[i]) <= reach)]
            if not same:
                at = at[own[at] != own[i]]
            at = at[(keys[at] == keys[i]).argmax(1) == here]
            if len(at):
                most = np.minimum(bins[at], bins[i]).sum(1)
                at = at[most + 1e-6 >= least * (size[at] + size[i] - most)]
            mine[sets[i]] = True
            for k in at:
                x, y = int(root[i]), int(root[k])
                if find(x) == find(y):
                    continue
                both = int(mine[sets[k]].sum())
                if both >= least * (int(size[i]) + int(size[k]) - both):
                    up[find(x)] = find(y)
                    yield x, y
            mine[sets[i]] = False

    def run(batches):
        group, rows = None, []
        for b in _slices(batches):
            out = []
            for r in zip(*(b.column(n).to_pylist() for n in ("band", "own", "root", "node", "text", "apart", "bands", "lo", "hi")), strict=True):
                if (r[0], r[7], r[8]) != group:
                    if rows:
                        out += links(group[0], rows)
                    group, rows = (r[0], r[7], r[8]), []
                rows.append(r[1:])
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})
        if rows:
            out = list(links(group[0], rows))
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    return run


def still_apart(placed: DataFrame, width: float, size: int) -> DataFrame:
    """The rows (band, node, root, apart) of members with one of another root in their bucket, whose distance differs by `width` at most.

    By a histogram of distances per bucket, with the least and the greatest root of each bin: a bucket has a bounded number of bins, whatever its size. size: about how many rows there are.
    """
    step = width / STEPS
    rows = placed.withColumn("bin", F.floor(F.col("apart") / step).cast("int"))
    bins = few(rows.groupBy("band", "bin").agg(F.min("root").alias("x"), F.max("root").alias("y")), size)
    open_ = bins.groupBy("band").agg(F.min("x").alias("x"), F.max("y").alias("y")).filter("x <> y").select("band")
    around = bins.join(open_, "band").select("band", F.explode(F.sequence(F.col("bin") - STEPS - 1, F.col("bin") + STEPS + 1)).alias("bin"), "x", "y")
    around = around.groupBy("band", "bin").agg(F.min("x").alias("x"), F.max("y").alias("y")).filter("x <> y").select("band", "bin")
    return rows.join(around, ["band", "bin"]).drop("bin")


def classes(docs: DataFrame, stash: Stash, width: int = WIDTH, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, weighted: bool = True, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(key, class_key, class_id, first_id, copies) of each distinct text with words: md5 as key, the class's own key, its least doc_id, the text's, and its rows."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(text_col)).alias("key"), F.col(text_col).alias("text")).filter("text is not null")
    signed = source.select("key", "text").mapInArrow(_sign(bands, rows, width, weighted), "key binary, bands array<long>, size long")
    nodes = stash.put(signed.dropDuplicates(["key"]).withColumn("node", F.monotonically_increasing_id()))
    n = nodes.count()
    narrow = lambda df, rows=n * bands: few(df, rows)
    firsts = stash.put(narrow(source.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), n))
    flat = nodes.select(F.explode("bands").alias("band"), "node")
    least = stash.put(narrow(flat.groupBy("band").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1").select("band", "a")))  # written, so that the join below may split a hot band
    shared = stash.put(narrow(flat.join(least, "band")))
    stars = stash.put(narrow(shared.filter("node <> a").select("a", F.col("node").alias("b")).distinct()))
    # Texts of the nodes that have a candidate, one for each: by the least id's row, so that copies don't gather at their key.
    wanted = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    at = lambda c: [F.coalesce(F.col(c), F.lit(0)).alias("_id"), F.col(c).isNull().alias("_none")]
    wanted = narrow(narrow(wanted, n).join(nodes.select("node", "key"), "node").join(firsts, "key"), n)
    wanted = stash.put(wanted.select("key", "node", *at("first_id")))
    # Few texts have a candidate, so the others are left out before the shuffle; the same plan at any size.
    mine = sieved(source.select("key", "text", *at("doc_id")), wanted, ["key", "_id", "_none"]).join(wanted.hint("merge"), ["key", "_id", "_none"])
    texts = stash.put(mine.dropDuplicates(["key", "_id", "_none"]).select("node", "text"))
    # A centre with many members gives its text to several tasks.
    fan = stash.put(narrow(stars.groupBy("a").agg(F.ceil(F.count("*") / FAN).cast("int").alias("fan")), n))
    salted = stars.join(fan, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("fan")).cast("int").alias("salt"))
    centres = texts.withColumnsRenamed({"node": "a", "text": "ta"}).join(fan, "a").select("a", "ta", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("salt"))
    pairs = salted.join(texts.withColumnsRenamed({"node": "b", "text": "tb"}), "b").join(centres, ["a", "salt"])
    judged = stash.put(pairs.select("a", "b", "ta", "tb").mapInArrow(_verify(width, similarity, weighted), "a long, b long, near boolean, apart double"))
    linked = judged.filter("near").select("a", "b")
    roots = components(linked, stash)
    placed = shared.join(judged.select("a", F.col("b").alias("node"), "apart"), ["a", "node"], "left").join(roots, "node", "left")
    placed = stash.put(narrow(placed.select("band", "node", F.coalesce("root", "node").alias("root"), F.coalesce("apart", F.lit(0.0)).alias("apart"))))
    rest = stash.put(narrow(still_apart(placed, 1 - similarity, n * bands).join(nodes.select("node", "size", "bands"), "node")))
    if rest.isEmpty():
        joined = roots
    else:
        shares = F.greatest(F.sum("size") / BLOCK, F.count("*") / MEMBERS)
        sizes = stash.put(narrow(rest.groupBy("band").agg(shares.alias("n"))))
        meet = in_blocks(rest.drop("size").join(sizes, "band"), "band", "node", "n", 1).join(texts, "node")
        meet = meet.select("band", "own", "root", "node", "text", "apart", "bands", "lo", "hi").repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")
        more = components(stash.put(meet.mapInArrow(_compare(width, similarity, weighted), "a long, b long")), stash).select(F.col("node").alias("root"), F.col("root").alias("top"))
        every = roots.unionByName(more.select(F.col("root").alias("node"), "root")).distinct()  # a text without a link so far is its own root
        joined = stash.put(narrow(narrow(every, n).join(more, "root", "left").groupBy("node").agg(F.min(F.coalesce("top", "root")).alias("root")), n))
    known = nodes.select("key", "node").join(joined, "node", "left").select("key", F.coalesce("root", "node").alias("class_key")).join(firsts, "key")
    known = stash.put(narrow(known, n))
    stash.drop(nodes, firsts, least, shared, stars, wanted, fan, texts, judged, placed, rest)
    heads = narrow(known.groupBy("class_key").agg(F.min("first_id").alias("class_id")), n)
    return stash.put(narrow(known.join(heads, "class_key").select("key", "class_key", "class_id", "first_id", "copies"), n))


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """doc_id and class_id, one row per row of `docs`."""
    stash = Stash(docs.sparkSession, "near-dedup")
    found = classes(docs, stash, **how)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5("text")).alias("key"))
    total = found.agg(F.sum("copies")).first()[0] or 0
    hot = found.filter(F.col("copies") * HOT > total).select("key")
    some = join_salted(rows.filter("key is not null"), found.select("key", "class_key", "class_id"), "key", hot, ["doc_id"], "left")
    some = some.select("doc_id", F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    return some.unionByName(rows.filter("key is null").select("doc_id", F.col("doc_id").alias("class_id")))  # nulls meet nothing


def op3_near_dedup(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def drop_near_duplicates(spark, docs, sf_dir):
    """Pipeline stage: of each class the document with the least doc_id stays (of equal ones, one row); texts that are null or without words stay.

    A class without ids keeps the text with the least key. An empty table gives no rows; texts of any length are compared whole; other columns pass through, whatever their names.
    """
    stash = Stash(spark, "near-dedup")
    found = classes(docs, stash)
    # The text that holds the class's least id; between equals, the least key. Rows meet it by key and id, so copies don't gather at their key.
    top = found.groupBy("class_key").agg(F.min(F.struct(F.col("first_id").isNull().alias("_none"), F.coalesce("first_id", F.lit(0)).alias("_id"), "key")).alias("m"))
    chosen = stash.put(top.select(F.col("m.key").alias("_key"), "m._id", "m._none"))
    keyed = packed(docs).withColumns({"_key": F.unhex(F.md5("text")), "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_none": F.col("doc_id").isNull()})
    wordless = F.col("text").isNull() | (F.regexp_replace("text", r"(?U)[\s\x1c-\x1f]+", "") == "")
    kept = keyed.filter(~wordless).join(chosen, ["_key", "_id", "_none"])
    first = kept.groupBy("_key", "_id", "_none").agg(F.min(F.struct("doc_id", "_rest", "text")).alias("m"))
    rows = first.select("m.doc_id", "m.text", "m._rest").unionByName(keyed.filter(wordless).select("doc_id", "text", "_rest"))
    return unpacked(rows, docs.columns)
