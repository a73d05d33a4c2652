import itertools
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import line_dedup as L
from millrace.llm import near_dedup as N
from millrace.llm.components import components, in_blocks, sieved
from millrace.session import Stash


def distance(a, b):
    while a and b and a[0] == b[0] and len(a) + len(b) > 300:  # long lines: what they share at the front changes nothing
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        a, b = a[n:], b[n:]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (x != y)))
        row = nxt
    return row[-1]


def edited(rng, s, n, letters="abc"):
    s = list(s)
    for _ in range(n):
        i, kind = rng.randint(0, len(s)), rng.randint(0, 2)
        if kind == 0:
            s.insert(i, rng.choice(letters))
        elif i < len(s):
            s[i : i + 1] = [] if kind == 1 else [rng.choice(letters)]
    return "".join(s)


def test_edit_distance_and_segments():
    rng = random.Random(5)
    for _ in range(20000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b = edited(rng, a, rng.randint(0, 4))
        d = distance(a, b)
        for k in (1, 2, 3):
            assert L.within(a, b, k) == (d <= k), (a, b, k)
            short, long = sorted((a, b), key=len)
            if d <= k and len(short) > k:
                entries = {(len(short), i, short[p : p + n]) for i, (p, n) in enumerate(L.segments(len(short), k))}
                assert entries & {(m, i, long[p : p + n]) for m, i, p, n in L.probes(len(long), k)}


def brute_lines(docs, edits=L.EDITS, least=L.MIN_CHARS):
    first = {}
    order = lambda i: (i is None, i or 0)
    for i, t in docs:
        for p, line in enumerate((t or "").split("\n") if t is not None else []):
            if len(line) >= least:
                first[line] = min(first.get(line, (order(i), p)), (order(i), p))
    bad = {b for a, b in itertools.permutations(first, 2) if first[a] < first[b] and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits}
    out = []
    for i, t in docs:
        if t is None:
            out.append((i, None))
            continue
        keep = [x for p, x in enumerate(t.split("\n")) if len(x) < least or (x not in bad and first[x] == (order(i), p))]
        out.append((i, "\n".join(keep)))
    return sorted(out, key=repr)


def line_case(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefg ") for _ in range(rng.randint(15, 60))) for _ in range(25)]
    docs = []
    for i in range(40):
        lines = [edited(rng, rng.choice(base), rng.choice((0, 0, 1, 2, 3)), "abcdefg") for _ in range(rng.randint(0, 6))]
        docs.append((i, "\n".join(lines)))
    return [*docs, (None, base[0] + "\n" + base[1]), (100, None), (101, ""), (3, docs[3][1]), (102, "z" * 70000), (103, "z" * 69999 + "y")]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [512, 3])
def test_line_dedup(spark, tiny, monkeypatch, seed, block):
    monkeypatch.setattr(L, "BLOCK", block)
    docs = line_case(seed)
    out = L.dedup_lines(tiny(docs).repartition(3))
    assert {"score", "key", "n"} <= set(out.columns)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == brute_lines(docs)


def test_line_dedup_letters_sieve(spark, tiny):
    """Many members in a bucket go through the sieve by letter counts."""
    rng = random.Random(9)
    stem = "".join(rng.choice("abcdefghij ") for _ in range(90))
    docs = [(i, edited(rng, stem, rng.randint(0, 5), "abcdefghij")) for i in range(80)]
    assert sorted(((r.doc_id, r.text) for r in L.dedup_lines(tiny(docs)).collect()), key=repr) == brute_lines(docs)


def test_line_dedup_clashing_names_and_null_ids(spark):
    one, two = "a line that is long enough to be judged", "another line of twenty characters or more"
    rows = [(None, one, "x", 1, 2, True, 3, 4), (None, two + "\n" + one, "x", 1, 2, True, 3, 4), (None, two + "\n" + one, "x", 1, 2, True, 3, 4), (1, one + "!", "x", 1, 2, True, 3, 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _id string, _drops int, _gone int, none boolean, did int, _rest int")
    out = L.dedup_lines(frame)
    assert out.columns == ["doc_id", "text", "_id", "_drops", "none", "did", "_rest", "_n_lines", "_gone"]
    got = out.collect()
    assert {(r._id, r._drops, r.none, r.did, r._rest) for r in got} == {("x", 1, True, 3, 4)}
    assert sorted((r.text for r in got), key=repr) == ["", one + "!", two, two]  # equal rows stay equal
    assert L.dedup_lines_stage(spark, frame, "").columns == frame.columns


@pytest.mark.parametrize("ids", [(None, None), (5, 5)])
def test_line_dedup_keeps_one_of_two_in_the_same_place(spark, tiny, ids):
    lines = ["the same long line about nothing, a", "the same long line about nothing, b"]
    texts = [r.text for r in L.dedup_lines(tiny(list(zip(ids, lines, strict=True)))).collect()]
    assert len(texts) == 2 and sorted(t in lines for t in texts) == [False, True]


def test_line_dedup_empty_and_stage(spark, tiny):
    assert L.dedup_lines(tiny([])).count() == 0
    one = "a line that is long enough to be judged"
    docs = tiny([(1, one + "\nshort"), (2, one), (3, ""), (4, None), (5, "short")])
    out = L.dedup_lines_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect() if r.text) == [(1, one + "\nshort", len(one) + 6), (5, "short", 5)]
    assert {r.doc_id for r in out.collect()} == {1, 3, 4, 5}  # 2 has nothing left; empty and null texts stay


def test_op5_whole_table(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    import hashlib

    want = {i: hashlib.md5(t.encode()).hexdigest() for i, t in brute_lines(docs)}
    assert {r.doc_id: r.text_md5 for r in L.op5_line_dedup(spark, small).collect()} == want


def test_full_filter_changes_nothing(spark, tiny, monkeypatch):
    monkeypatch.setattr(L, "FILTER_BITS", 1 << 10)
    docs = line_case(3)
    assert sorted(((r.doc_id, r.text) for r in L.dedup_lines(tiny(docs)).collect()), key=repr) == brute_lines(docs)


def brute_classes(docs, least=N.SIMILARITY, weighted=True):
    texts = sorted({t for _, t in docs if t is not None and t.split()})
    sets = [N.shingle_set(t, weighted=weighted) for t in texts]
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if N.similar(sets[i], sets[j], least):
            up[find(i)] = find(j)
    ids = {}
    for i, t in docs:
        if t is not None and t.split() and i is not None:
            r = find(texts.index(t))
            ids[r] = min(ids.get(r, i), i)
    return sorted(((i, ids.get(find(texts.index(t))) if t is not None and t.split() else i) for i, t in docs), key=repr)


def near_case(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice((3, 6, 40, 80, 200)))] for _ in range(8)]
    docs = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 5, 9))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        docs.append((i, rng.choice((" ", "\n")).join(words)))
    return [*docs, (None, docs[0][1]), (None, "only nulls have this text here"), (200, None), (201, ""), (202, " \n "), (5, docs[5][1]), (203, "one"), (204, "one"), (205, "w " * 40000)]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize(("block", "fan", "weighted"), [(N.BLOCK, N.FAN, True), (300, 3, True), (300, 3, False)])
def test_near_dedup(spark, tiny, monkeypatch, seed, block, fan, weighted):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "FAN", fan)
    monkeypatch.setattr(N, "MEMBERS", 512 if block == N.BLOCK or weighted else 3)
    docs = near_case(seed)
    got = N.near_duplicates(tiny(docs).repartition(3), weighted=weighted).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == brute_classes(docs, weighted=weighted)


def test_weights_are_numbers_of_occurrences():
    """Bags by counts, against the set of numbered occurrences."""
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("ab") for _ in range(rng.randint(5, 40))] for _ in range(2))
        x, y = (Counter(zip(*(t[i:] for i in range(5)), strict=False)) for t in (a, b))
        s, t = N.shingle_set(" ".join(a)), N.shingle_set(" ".join(b))
        assert len(s & t) == (x & y).total() and len(s | t) == (x | y).total()


def test_shingle_ids_are_the_sets():
    """The numbers that a block's texts get say what their shingles say, in a small part of the memory."""
    import tracemalloc

    rng = random.Random(8)
    for weighted in (True, False):
        texts = [" ".join(rng.choice("abc") for _ in range(rng.choice((1, 2, 4, 5, 6, 30, 200)))) for _ in range(60)]
        sets, ids = [N.shingle_set(t, weighted=weighted) for t in texts], N.shingle_ids(texts, weighted=weighted)
        assert [len(x) for x in sets] == [len(set(x.tolist())) for x in ids] == [len(x) for x in ids]
        for i, j in itertools.combinations(range(len(texts)), 2):
            assert len(sets[i] & sets[j]) == len(set(ids[i].tolist()) & set(ids[j].tolist()))
    words = [str(i) for i in range(200_000)]  # numbers of five such words don't fit 64 bits: they are ranked on the way
    texts = [" ".join(rng.choice(words) for _ in range(2000)) for _ in range(100)]
    ids = N.shingle_ids([*texts, texts[0]])
    assert (ids[0] == ids[-1]).all() and len(set(np.concatenate(ids[:-1]).tolist())) == 100 * 1996
    most = []
    for made in (lambda: N.shingle_ids(texts), lambda: [N.shingle_set(t) for t in texts]):
        tracemalloc.start()
        _held = made()
        most.append(sum(x.nbytes for x in _held) if isinstance(_held[0], np.ndarray) else tracemalloc.get_traced_memory()[0])
        tracemalloc.stop()
    assert most[0] * 10 < most[1]


@pytest.mark.parametrize("bits", [1 << 10, 1 << 25])
def test_sieved_keeps_all_partners(spark, bits):
    left = spark.range(20_000).selectExpr("id", "if(id % 7 = 0, null, cast(id as string)) s")
    right = spark.range(0, 20_000, 40).selectExpr("id", "if(id % 7 = 0, null, cast(id as string)) s")
    got = [r.id for r in sieved(left, right, ["id", "s"], bits).collect()]
    assert len(got) == len(set(got)) and {r.id for r in right.collect()} <= set(got)
    assert len(got) < (10_000 if bits == 1 << 10 else 3_000)
    assert sieved(left, right.limit(0), ["id"]).count() == 0


def test_texts_without_candidates_are_not_shuffled(spark, tiny):
    """Of whole texts, only those with a candidate go through a shuffle, also where the wanted keys are too many for a broadcast."""
    rng = random.Random(1)
    texts = [" ".join(str(rng.randrange(10**9)) for _ in range(3000)) for _ in range(60)]
    frame = tiny(list(enumerate([*texts, texts[0] + " x"])))
    context, gateway = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway

    def shuffled():
        context.listenerBus().waitUntilEmpty(30_000)
        none = gateway.jvm.java.util.ArrayList()
        stages = context.statusStore().stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = shuffled()
        assert sum(r.class_id != r.doc_id for r in N.near_duplicates(frame).collect()) == 1
        assert shuffled() - before < sum(map(len, texts)) / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_still_apart_keeps_every_pair_that_can_be_similar(spark):
    rng = random.Random(5)
    rows = [(g, i, rng.randrange(3) if i else 0, rng.choice((0.01, 0.3, rng.random()))) for g in range(6) for i in range(12)]
    got = {(r.band, r.node) for r in N.still_apart(spark.createDataFrame(rows, "band int, node int, root int, apart double"), 0.2, len(rows)).collect()}
    for g, i, r, d in rows:
        near = [x for x in rows if x[0] == g and x[2] != r and abs(x[3] - d) <= 0.2]
        assert not near or (g, i) in got
    assert len(got) < len(rows)


def test_near_dedup_empty(spark, tiny):
    assert N.near_duplicates(tiny([])).count() == 0
    assert N.drop_near_duplicates(spark, tiny([]), "").count() == 0


def test_near_dedup_stage_keeps_one_of_each_class(spark, tiny):
    docs = near_case(4)
    frame = tiny(docs)
    out = N.drop_near_duplicates(spark, frame, "")
    assert out.columns == frame.columns
    classes = dict.fromkeys(c for i, c in brute_classes(docs) if c is not None)
    kept = [r for r in out.collect()]
    assert sorted(r.doc_id for r in kept if r.doc_id is not None and (r.text or "").split()) == sorted(c for c in classes if c not in (200, 201, 202))
    assert {200, 201, 202} <= {r.doc_id for r in kept}


def test_op3_whole_table(spark, small):
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.class_id) for r in N.op3_near_dedup(spark, small).collect()), key=repr) == brute_classes(docs)


def test_darts_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 60).astype(np.uint64)
    a, b = rng.uniform(0.2, 6, 60), rng.uniform(0.2, 6, 60)
    a[:10], b[50:] = 0, 0
    x, y = a > 0, b > 0
    k = 4000
    sig = N.dart_signatures(np.concatenate([h[x], h[y]]), np.concatenate([a[x], b[y]]), np.repeat([0, 1], [x.sum(), y.sum()]), 2, k)
    assert abs((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03
    # A text's signature doesn't depend on what stands beside it.
    alone = N.dart_signatures(h[x], a[x], np.zeros(x.sum(), int), 1, k)
    assert (alone[0] == sig[0]).all()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Stash(spark, "t")).collect()}
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in up if any(x in e and e[0] != e[1] for e in edges)}


def test_in_blocks_every_pair_meets_once(spark):
    rows = spark.createDataFrame([(1, i, 23) for i in range(23)] + [(2, i, 4) for i in range(4)], "g int, m int, n int")
    got = in_blocks(rows, "g", "m", "n", 5).collect()
    for g, n in ((1, 23), (2, 4)):
        cells = {}
        for r in got:
            if r.g == g:
                cells.setdefault((r.lo, r.hi), []).append(r)
        met = [frozenset((a.m, b.m)) for (lo, hi), c in cells.items() for a, b in itertools.combinations(c, 2) if lo == hi or a.own != b.own]
        assert len(met) == len(set(met)) == n * (n - 1) // 2
